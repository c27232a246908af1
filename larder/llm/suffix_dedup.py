"""Repeated byte strings found by merging shard Burrows-Wheeler transforms.

1. Routing.  Every start of a 200-byte string has a name, the smallest hash of the 100-byte pieces
   inside it.  Equal strings have equal names, so a name that occurs once in the corpus has no
   repeat; the others' stretches of text (runs of starts with one name) go to the task of their
   name.  Equal stretches become one with a weight before the shuffle.
2. Transforms.  A task cuts its stretches into shards and takes each shard's transform over
   40-byte symbols.  The shards are merged by iterative interleave refinement: a round moves every
   entry to the bucket of its preceding symbol, stably, so after h rounds the interleave is sorted
   by h symbols, with no comparison of suffixes.  A border between neighbours appears in the round
   that first tells them apart, which gives their common prefix; intervals without a border after
   five rounds are equal 200-byte strings, and those of weight two or more are repeated.
3. Removal.  Starts go back to their texts, whose covered bytes are removed.

A name with more stretches than a task should hold is cut by the whole string instead of by name
(``split_names``), so no group gathers without bound.

Defined results
    NULL or empty text: no bytes, nothing removed, no spans, hash of the empty string.  NULL
    doc_id: kept.  Repeated rows: exact copies of 200 bytes or more remove each other wholly.
    Shorter texts lose nothing.  Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import common as C

U64 = np.uint64
_TOP = U64(2**64 - 1)


@dataclass(frozen=True)
class SuffixParams:
    width: int = 200
    piece: int = 100
    #: Bytes of one symbol of the transforms; divides ``width``.
    symbol: int = 40
    shards: int = 4
    #: Bytes of text merged at once by a task.
    batch_bytes: int = 56 << 10
    #: Starts of one stretch at most (longer runs are cut, no start is lost).
    stretch: int = 1024
    #: Different stretches of one name that stay together in a task.
    name_stretches: int = 20_000
    bits: int = 1 << 26


def sliding(values: np.ndarray, width: int, take, fill) -> np.ndarray:
    """take (minimum or maximum) over every ``width`` consecutive values: two block-wise passes."""
    n = len(values)
    if n < width:
        return np.zeros(0, values.dtype)
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = take.accumulate(blocks, axis=1).ravel()
    back = take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(back[:n - width + 1], ahead[width - 1:n])


def names(data: np.ndarray, offsets: np.ndarray, params: SuffixParams):
    """(hash of each piece, name of each start, mask of starts inside one document)."""
    prefix = C.prefix_hash(data)
    pieces = C.window_hash(prefix, params.piece)
    name = sliding(pieces, params.width - params.piece + 1, np.minimum, _TOP)
    valid = np.zeros(len(name) + 1, np.int32)
    lengths = np.diff(offsets)
    some = lengths >= params.width
    np.add.at(valid, offsets[:-1][some], 1)
    np.add.at(valid, offsets[1:][some] - params.width + 1, -1)
    return pieces, name, np.cumsum(valid)[:len(name)] > 0


def chosen(pieces: np.ndarray, name: np.ndarray, valid: np.ndarray, params: SuffixParams) -> np.ndarray:
    """Positions of pieces that are the smallest of some valid start's string."""
    span = params.width - params.piece + 1
    if not len(name):
        return np.zeros(0, np.int64)
    padded = np.zeros(len(pieces) + span - 1, U64)
    padded[span - 1:span - 1 + len(name)] = np.where(valid, name, U64(0))
    top = sliding(padded, span, np.maximum, U64(0))
    return np.flatnonzero((top == pieces) & (top > 0))


def shared_names(docs: DataFrame, params: SuffixParams) -> np.ndarray:
    """Bitmap of names that occur at two places or more in the corpus."""

    def run(batches):
        for _, data, offsets in C.chunks(batches, "text"):
            pieces, name, valid = names(data, offsets, params)
            found, n = np.unique(pieces[chosen(pieces, name, valid, params)], return_counts=True)
            yield pa.RecordBatch.from_pydict({"name": pa.array(C.signed(found)), "n": pa.array(n.astype(np.int32))})

    counts = docs.select("text").mapInArrow(run, "name long, n int").groupBy("name").agg(F.sum("n").alias("n"))
    return C.bitmap(counts.where("n > 1"), "name", params.bits)


STRETCH = "name long, r1 long, r2 long, t1 long, t2 long, start long, several int, body binary"


def stretches(docs: DataFrame, marks: np.ndarray, params: SuffixParams) -> DataFrame:
    """Runs of starts with one shared name, each with its text (columns ``STRETCH``)."""

    def run(batches):
        seen = C.Seen()
        for _, data, offsets in C.chunks(batches, "text"):
            pieces, name, valid = names(data, offsets, params)
            alive = valid & C.in_bitmap(marks, name) if len(name) else valid
            at = np.flatnonzero(alive)
            if not len(at):
                continue
            owner = np.searchsorted(offsets, at, side="right") - 1
            fresh = np.r_[True, (np.diff(at) != 1) | (np.diff(owner) != 0) | (name[at[1:]] != name[at[:-1]])]
            heads = np.flatnonzero(fresh)
            # cut long runs at a fixed number of starts
            since = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
            heads = np.flatnonzero(fresh | (since % params.stretch == 0))
            count = np.diff(np.r_[heads, len(at)])
            first = at[heads]
            where = chosen(pieces, name, valid, params)
            low, high = np.searchsorted(where, first), np.searchsorted(where, first + count + params.width - params.piece)
            several = np.zeros(len(heads), np.int32)
            for t in range(int((high - low).max())):
                inside = low + t < high
                several += inside & (pieces[where[np.minimum(low + t, len(where) - 1)]] == name[first])
            body, owner = data.tobytes(), owner[heads]
            texts: dict[int, tuple[int, int] | None] = {}
            rows = []
            for o, s, n, k, v in zip(owner.tolist(), first.tolist(), count.tolist(), several.tolist(), C.signed(name[first]).tolist()):
                if o not in texts:
                    text = C.digest(body[offsets[o]:offsets[o + 1]])
                    texts[o] = None if seen.again(text) else text
                if texts[o] is not None:
                    part = body[s:s + n - 1 + params.width]
                    rows.append((v, *C.digest(part), *texts[o], s - int(offsets[o]), k, part))
            if rows:
                kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in STRETCH.split(", ")])

    return docs.select("text").mapInArrow(run, STRETCH)


# ---------------------------------------------------------------------------------------
# transforms
# ---------------------------------------------------------------------------------------


def bucket_order(symbols: np.ndarray) -> np.ndarray:
    """Stable order by symbol: sorting by 16 bits at a time takes linear time."""
    low = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if not len(symbols) or int(symbols.max()) < 1 << 16:
        return low
    return low[np.argsort((symbols[low] >> 16).astype(np.uint16), kind="stable")]


class Collection:
    """The stretches of one batch as symbol texts.

    Slot p of a stretch of m bytes (p = 0..m) stands for the suffix p, p + symbol, ...; the last
    ``symbol`` slots are ends.  ``symbol[p]`` is the rank of the symbol at p, 0 for an end."""

    def __init__(self, bodies: list[bytes], size: int):
        self.size = size
        lengths = np.array([len(b) for b in bodies], np.int64)
        self.first = np.r_[0, np.cumsum(lengths + 1)]
        data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
        hashes = np.zeros(len(data), U64)
        found = C.window_hash(C.prefix_hash(data), size)
        hashes[:len(found)] = found
        slot = np.arange(len(data)) - np.repeat(self.first[:-1], lengths + 1)
        self.end = slot > np.repeat(lengths, lengths + 1) - size
        self.begin = slot < size  # no symbol precedes these
        self.symbol = np.zeros(len(data), np.int32)
        inner = ~self.end
        self.symbol[inner] = np.unique(hashes[inner], return_inverse=True)[1] + 1

    def preceding(self, suffixes: np.ndarray) -> np.ndarray:
        """The transform: the symbol before each suffix, 0 where there is none."""
        before = self.symbol[np.maximum(suffixes - self.size, 0)]
        return np.where(self.begin[suffixes], 0, before)

    def shard(self, low: int, high: int, rounds: int) -> np.ndarray:
        """Suffixes of the slots low..high sorted by ``rounds`` symbols, ends first: each round
        moves every suffix's predecessor into its symbol's bucket, stably."""
        slots = np.arange(low, high)
        ends, order = slots[self.end[low:high]], slots
        for _ in range(rounds):
            moved = order[~self.begin[order]] - self.size
            order = np.r_[ends, moved[bucket_order(self.symbol[moved])]]
        return order


def merge(collection: Collection, shards: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted shards by interleave refinement: (suffixes in merged order, common prefix in
    symbols of each with the one before, ``rounds`` where they are not told apart).

    The interleave says only from which shard each place is filled; a shard's suffixes are used in
    their own order.  Round h makes it right for h symbols."""
    interleave = np.repeat(np.arange(len(shards), dtype=np.int16), [len(s) for s in shards])
    transforms = [collection.preceding(s) for s in shards]
    n = len(interleave)
    common = np.full(n, rounds, np.int16)
    group = np.zeros(n, np.int32)
    n_ends = int(collection.end.sum())
    for h in range(rounds):
        before = np.empty(n, np.int32)
        for i, transform in enumerate(transforms):
            before[interleave == i] = transform
        move = bucket_order(before)
        interleave = interleave[move]
        bucket, inner = before[move], group[move]
        border = np.r_[True, (bucket[1:] != bucket[:-1]) | (inner[1:] != inner[:-1])]
        border[:n_ends] = True  # ends are all different
        common[border & (common == rounds)] = h
        group = np.cumsum(border, dtype=np.int32)
    merged = np.empty(n, np.int64)
    for i, shard in enumerate(shards):
        merged[interleave == i] = shard
    return merged, common


def repeated_starts(bodies: list[bytes], weights: np.ndarray, params: SuffixParams) -> list[np.ndarray]:
    """For each stretch, the starts whose ``width`` bytes have weight two or more in the batch."""
    rounds = params.width // params.symbol
    collection = Collection(bodies, params.symbol)
    n_shards = max(1, min(params.shards, len(bodies)))
    cuts = [int(collection.first[len(bodies) * i // n_shards]) for i in range(n_shards + 1)]
    merged, common = merge(collection, [collection.shard(a, b, rounds) for a, b in zip(cuts[:-1], cuts[1:])], rounds)
    interval = np.cumsum(common < rounds) - 1
    stretch = np.searchsorted(collection.first, merged, side="right") - 1
    weight = np.bincount(interval, weights=weights[stretch])
    slot = merged - collection.first[stretch]
    length = np.diff(collection.first)[stretch] - 1
    hit = (weight[interval] >= 2) & (slot + params.width <= length)
    order = np.lexsort((slot[hit], stretch[hit]))
    return np.split(slot[hit][order], np.cumsum(np.bincount(stretch[hit], minlength=len(bodies)))[:-1])


def _intervals(starts: np.ndarray) -> list[int]:
    """Runs of consecutive starts as first << 32 | length."""
    if not len(starts):
        return []
    heads = np.flatnonzero(np.r_[True, np.diff(starts) != 1])
    return ((starts[heads].astype(np.int64) << 32) | np.diff(np.r_[heads, len(starts)])).tolist()


def repeats_by_name(distinct: DataFrame, params: SuffixParams) -> DataFrame:
    """(r1, r2, spans): the repeated starts of each stretch, from transforms merged per task."""

    def solve(rows, copies):
        bodies = [r[4] for r in rows]
        found = repeated_starts(bodies, np.array([r[3] for r in rows], np.float64), params) if rows else []
        out = copies + [(r[1], r[2], _intervals(at)) for r, at in zip(rows, found) if len(at)]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.int64()))],
            ["r1", "r2", "spans"])

    def run(batches):
        pending, copies, size, group = [], [], 0, []

        def close(group):
            # one stretch, once, with one place for its name has no partner anywhere
            if len(group) == 1 and group[0][3] == 1 and group[0][5] < 2:
                return []
            # where every stretch has copies, each of their intervals has weight two or more
            if all(r[3] > 1 for r in group):
                copies.extend((r[1], r[2], [len(r[4]) - params.width + 1]) for r in group)
                return []
            return group

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if group and row[0] != group[0][0]:
                    closed = close(group)
                    pending += closed
                    size += sum(len(r[4]) for r in closed)
                    group = []
                    if size >= params.batch_bytes or len(copies) > 50_000:
                        yield solve(pending, copies)
                        pending, copies, size = [], [], 0
                group.append(row)
        pending += close(group)
        if pending or copies:
            yield solve(pending, copies)

    rows = distinct.select("name", "r1", "r2", "weight", "body", "several").repartition("name").sortWithinPartitions("name", "r1", "r2")
    return rows.mapInArrow(run, "r1 long, r2 long, spans array<long>")


def split_names(distinct: DataFrame, params: SuffixParams) -> DataFrame:
    """The same for names with too many stretches for one task: their single strings are named by
    96 bits and summed by Spark, so the group is spread over all tasks."""

    def run(batches):
        for batch in batches:
            for r1, r2, weight, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                keys = [C.digest(body[i:i + params.width]) for i in range(len(body) - params.width + 1)]
                n = len(keys)
                yield pa.RecordBatch.from_pydict({
                    "c1": pa.array([k[0] for k in keys], pa.int64()), "c2": pa.array([k[1] for k in keys], pa.int64()), "r1": pa.array([r1] * n, pa.int64()),
                    "r2": pa.array([r2] * n, pa.int64()), "weight": pa.array([weight] * n, pa.int64()), "at": pa.array(np.arange(n))})

    strings = distinct.select("r1", "r2", "weight", "body").mapInArrow(run, "c1 long, c2 long, r1 long, r2 long, weight long, at long")
    twice = strings.groupBy("c1", "c2").agg(F.sum("weight").alias("n")).where("n > 1").select("c1", "c2")
    hit = strings.join(twice, ["c1", "c2"], "left_semi")
    return hit.groupBy("r1", "r2").agg(F.collect_list(F.shiftleft("at", 32) + 1).alias("spans"))


def substring_dedup(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    scratch = C.Scratch(docs.sparkSession, "suffix")
    whole = scratch.keep(C.copies(docs, len, params.width).select("t1", "t2"), "whole")
    marks = shared_names(docs, params)
    places = scratch.keep(stretches(docs, marks, params), "places")
    distinct = scratch.keep(places.groupBy("r1", "r2").agg(F.first("name").alias("name"), F.count("*").alias("weight"),
                                                           F.max("several").alias("several"), F.first("body").alias("body")), "distinct")
    many = distinct.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > params.name_stretches)
    crowded = scratch.keep(many.select("name"), "crowded")
    if crowded.isEmpty():
        repeats = repeats_by_name(distinct, params)
    else:
        repeats = (repeats_by_name(distinct.join(crowded, "name", "left_anti"), params)
                   .unionByName(split_names(distinct.join(crowded, "name", "left_semi"), params)))
    repeats = scratch.keep(repeats, "repeats")
    scratch.drop("distinct", "crowded")
    spans = places.select("r1", "r2", "t1", "t2", "start").join(repeats, ["r1", "r2"])
    spans = spans.select("t1", "t2", F.transform("spans", lambda x: x + F.shiftleft(F.col("start"), 32)).alias("spans"))
    found = spans.groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("found"))
    covered = scratch.keep(found.join(whole, ["t1", "t2"], "left_anti"), "covered")
    scratch.drop("places", "repeats")
    width = params.width

    def removed(text: bytes, found) -> tuple[tuple[int, ...], str]:
        at = found.to_numpy(zero_copy_only=False).astype(np.int64)
        first, count = at >> 32, at & 0xFFFFFFFF
        edge = np.zeros(len(text) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + count - 1 + width, -1)
        gone = np.cumsum(edge)[:-1] > 0
        n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        return (int(gone.sum()), n_spans), hashlib.sha256(kept).hexdigest()

    out = C.finish(docs, whole, covered, removed, len, lambda t: hashlib.sha256(t).hexdigest(), ("n_removed", "n_spans"))
    return out.withColumnRenamed("size", "n_bytes")
