"""Packing token sequences with few bins: a configuration linear program over the length
histogram.

A configuration says how many pieces of each length share one sequence.  Multiplicative weights
over the lengths price configurations with a knapsack dynamic program, which yields a fractional
solution of the configuration program; its whole part is used as it is, and best fit over the
histogram of the rest repairs the rounding.  The driver sees only the histogram (at most
``capacity`` rows).  Pieces get their places from ranks that Spark counts in two levels.

Defined results
    NULL or empty text: the single end id 0.  NULL doc_id: kept as NULL.
    Repeated rows: each is packed.  Ties between like pieces: by doc_id, piece, checksum.
    Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import common as C

CAPACITY = 2048
#: Id that ends every document.
END = 0
#: Bytes of text whose words are told apart at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 22
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class PackingParams:
    capacity: int = CAPACITY
    #: Multiplicative-weights steps, each with one knapsack pricing.
    rounds: int = 600
    #: Share of a length's demand that one step may cover, and the scale on which weights decay.
    step: float = 0.35
    #: Starting weights grow as this power of the length: long pieces are the harder to place.
    tilt: float = 1.1
    #: Pieces per rank bucket: bounds what one task sorts.
    bucket_rows: int = 100_000


# ---------------------------------------------------------------------------------------
# tokens and pieces
# ---------------------------------------------------------------------------------------


def _table(*members: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_LETTER = _table(*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_ALNUM = _LETTER | _table(*b"0123456789")
#: Signs that the tokenizer reads as a run of their own after a letter or digit; an apostrophe may begin a contraction.
_SIGN = _table(*b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
#: Second bytes, after 0xC3, of the letters U+00C0 to U+00FF (two of that range are signs).
_LATIN = _table(*(set(range(0x80, 0xC0)) - {0x97, 0xB7}))


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The runs of ``data`` between neighbouring offsets."""
    kind, width = (pa.binary(), np.int32) if len(data) < 2**31 else (pa.large_binary(), np.int64)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(data)])


def _listed(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The same as Python objects; much faster than asking Arrow for them one by one."""
    body, at = bytes(data), offsets.tolist()
    return [body[a:b] for a, b in zip(at[:-1], at[1:])]


class Vocabulary:
    """Ids of words as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids
    in a row.  It also never joins letters or digits with the signs after them and reads letters in
    lower case, so words are looked up without trailing signs and in lower case.  Words of letters
    only are encoded many at a time as one text: the last id of each, and no other, ends a word.
    Arrow tells the words of a chunk apart, so Python meets each of them once a chunk only.
    One per tokenizer file and Python worker, of bounded size."""

    known: dict[str, Vocabulary] = {}

    def __init__(self, path: str, remember: int = 350_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.remember = remember
        self.ids: dict[bytes, bytes] = {b"": b""}  # of what is looked up
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words without white space between them: their bytes as they are looked up, where the signs after
        each begin, and whether it is letters only up to there; a word that may hold a special token stays
        whole, and one with other than ASCII and Latin-1 letters keeps its case."""
        body = np.append(data, np.uint8(ord(" ")))
        start, stop = offsets[:-1], offsets[1:]
        pair = (body[:-1] == 0xC3) & _LATIN[body[1:]]
        latin = np.r_[pair, False] | np.r_[False, pair]
        kind = np.int32 if len(body) < 2**31 else np.int64
        last = np.maximum.accumulate(np.where(_SIGN[body], kind(-1), np.arange(len(body), dtype=kind)))[stop - 1]
        whole = np.zeros(len(stop), bool)
        whole[np.searchsorted(stop, np.flatnonzero((body[:-1] == ord("<")) & (body[1:] == ord("|"))), side="right")] = True
        cut = np.where(~whole & (last >= start) & (_ALNUM[body[last]] | latin[last]), last + 1, stop)
        count = lambda mask, a, b: (total := np.r_[kind(0), np.cumsum(mask, dtype=kind)])[b] - total[a]
        lower = ~whole & (count((body >= 0x80) & ~latin, start, stop) == 0)
        low = C.LOWER[body]
        low[1:][pair & (body[1:] < 0x9F)] += 0x20
        plain = lower & (count(_LETTER[body] | latin, start, cut) == cut - start)
        return np.where(np.repeat(lower, stop - start), low[:-1], data), cut, plain

    @classmethod
    def parts(cls, words: list[bytes]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """(what is looked up, signs after it, whether it is letters only) of each word."""
        data, offsets = C.raw(pa.array(words, pa.binary()))
        data, cut, plain = cls.cuts(data, offsets)
        both = _listed(data, np.r_[np.c_[offsets[:-1], cut].ravel(), offsets[-1:]])
        return both[::2], both[1::2], plain

    def learn(self, plain: list[bytes], others: list[bytes], at_once: int = 50) -> None:
        """Ids of new words; ``plain`` are letters only."""
        for start in range(0, len(plain), 10_000):
            some = plain[start:start + 10_000]
            texts = [b" ".join(some[i:i + at_once]).decode("utf-8") for i in range(0, len(some), at_once)]
            found = [e.ids for e in self.encode(texts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            due = np.minimum(np.arange(1, len(texts) + 1) * at_once, len(some))  # words up to the end of each text
            if len(stops) != len(some) or (stops[due - 1] != np.cumsum([len(x) for x in found])).any():
                others = others + some  # a tokenizer that does not mark the ends of words
                continue
            body, stops = ids.tobytes(), (4 * stops).tolist()
            self.ids.update((w, body[a:b]) for w, a, b in zip(some, [0, *stops], stops))
        for start in range(0, len(others), 10_000):
            some = others[start:start + 10_000]
            for word, found in zip(some, self.encode([w.decode("utf-8") for w in some], add_special_tokens=False)):
                self.ids[word] = np.asarray(found.ids, "<u4").tobytes()

    def look_up(self, parts: list[bytes], plain: list[bool]) -> list[bytes]:
        """The ids of each part of a word; ``plain`` are letters only.  Each is named once."""
        if len(self.ids) > self.remember:  # what is asked for again outlives the change
            self.older, self.ids = self.ids, {b"": b""}
        ids = self.ids
        found = list(map(ids.get, parts))
        missing = [i for i, known in enumerate(found) if known is None]
        letters, others = [], []
        for i in missing:
            part = parts[i]
            if part in self.older:
                ids[part] = self.older[part]
            else:
                (letters if plain[i] else others).append(part)
        self.learn(letters, others)
        for i in missing:
            found[i] = ids[parts[i]]
        return found

    def encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, n + 1 offsets of the texts there in bytes)."""
        start, stop, first = C.words(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
        words = _binary(data[~C._SPACE[data]], np.r_[0, np.cumsum(stop - start)]).dictionary_encode()
        # a word is its letters or digits and the signs after them
        data, offsets = C.raw(words.dictionary)
        data, cut, plain = self.cuts(data, offsets)
        parts = _binary(data, np.r_[np.c_[offsets[:-1], cut].ravel(), offsets[-1:]]).dictionary_encode()
        letters = np.zeros(len(parts.dictionary), bool)
        letters[parts.indices.to_numpy()[::2]] = plain
        ids = pa.array(self.look_up(_listed(*C.raw(parts.dictionary)), letters.tolist()), pa.large_binary())
        body, at = C.raw(ids.take(parts.indices))
        ids = pa.Array.from_buffers(pa.large_binary(), len(plain), [None, pa.py_buffer(at[::2].copy()), pa.py_buffer(body)])
        body, at = C.raw(ids.take(words.indices))
        return body, at[first]

    def tokens(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as words."""
        body, at = self.encoded(*C.raw(pa.array([b" ".join(words) for words in texts], pa.binary())))
        return _listed(body, at)


def forget() -> None:
    """Give back what this worker learnt, and what Arrow keeps of freed chunks."""
    if Vocabulary.known:
        Vocabulary.known.clear()
        pa.default_memory_pool().release_unused()


C.HELD.append(forget)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document (doc_id, text): ids of the whole text and the end id,
    cut every ``capacity`` ids.  ``with_ids`` adds the ids themselves."""

    def run(batches):
        vocabulary = Vocabulary.of(tokenizer_path)
        end = np.asarray([END], "<u4").tobytes()
        for part, data, offsets in C.chunks(batches, "text", CHUNK_BYTES):
            rows, ids = [], part.column(part.schema.get_field_index("doc_id")).to_pylist()
            for doc_id, own_tokens in zip(ids, _listed(*vocabulary.encoded(data, offsets))):
                tokens = own_tokens + end
                for piece, start in enumerate(range(0, len(tokens) // 4, capacity)):
                    own = tokens[4 * start:4 * (start + capacity)]
                    row = (doc_id, piece, start, len(own) // 4, zlib.crc32(own))
                    rows.append((*row, np.frombuffer(own, "<i4").tolist()) if with_ids else row)
            if rows:
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names[:len(rows[0])])

    schema = PIECES_SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# ---------------------------------------------------------------------------------------
# configurations
# ---------------------------------------------------------------------------------------


def price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each length in the most valuable configuration (unbounded knapsack)."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    shortest = int(lengths[0])
    for c in range(shortest, capacity + 1):
        fits = int(np.searchsorted(lengths, c, side="right"))
        gain = best[c - lengths[:fits]] + value[:fits]
        i = int(gain.argmax())
        if gain[i] > best[c - 1]:
            best[c], taken[c] = gain[i], i
        else:
            best[c] = best[c - 1]
    out, c = np.zeros(len(lengths), np.int64), capacity
    while c >= shortest:
        if taken[c] < 0:
            c -= 1
        else:
            out[taken[c]] += 1
            c -= int(lengths[taken[c]])
    return out


def fractional(lengths: np.ndarray, demand: np.ndarray, params: PackingParams) -> list[tuple[np.ndarray, float]]:
    """(configuration, times used) of an approximate solution of the covering program
    min sum(x) with sum_c c[l] x[c] >= demand[l].  The weight of a length decays exponentially
    with the share of its demand that is covered; each step prices the best configuration under
    the weights and uses it as far as ``step`` and the open demand allow."""
    covered, found = np.zeros(len(lengths)), []
    start = (lengths / params.capacity) ** params.tilt
    for _ in range(params.rounds):
        value = np.where(demand - covered >= 1, start * np.exp(-(covered / demand) / params.step), 0.0)
        if not value.any():
            break
        config = np.minimum(price(lengths, value, params.capacity), np.floor(demand - covered)).astype(np.int64)
        used = np.flatnonzero(config)
        open_for = np.min((demand[used] - covered[used]) / config[used])
        times = float(min(open_for, np.min(params.step * demand[used] / config[used])))
        covered += times * config
        found.append((config, times))
    return found


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing on counts: [(pattern of (length, copies), sequences)]."""
    bins: dict[int, list[list]] = defaultdict(list)  # free space -> [pattern, how many]
    for length, count in sorted(zip(lengths.tolist(), counts.tolist()), reverse=True):
        while count > 0:
            space = min((s for s, v in bins.items() if v and s >= length), default=None)
            if space is not None:
                pattern, many = bins[space].pop()
                take = min(many, count)
                if many > take:
                    bins[space].append([pattern, many - take])
                # as many more copies of this length as fit, when there are enough for all
                each = max(1, min(space // length, count // take))
                bins[space - each * length].append([pattern + ((length, each),), take])
                count -= take * each
            else:
                each = max(1, min(capacity // length, count))
                many = count // each
                bins[capacity - each * length].append([((length, each),), many])
                count -= many * each
    merged: dict[tuple, int] = defaultdict(int)
    for groups in bins.values():
        for pattern, many in groups:
            merged[pattern] += many
    return sorted(merged.items())


def rounded(lengths: np.ndarray, demand: np.ndarray, found: list[tuple[np.ndarray, float]], least: float, capacity: int) -> list:
    """Whole sequences from a fractional solution: every configuration used ``least`` times or
    more is rounded down, and best fit places what is left."""
    out, left = [], demand.copy()
    for config, times in found:
        used = np.flatnonzero(config)
        whole = int(min(np.floor(times + 1e-9), (left[used] // config[used]).min()))
        if whole > 0 and times >= least:
            left = left - whole * config
            out.append((tuple((int(lengths[i]), int(config[i])) for i in used[::-1]), whole))
    more = left > 0
    return out + best_fit(lengths[more], left[more], capacity)


def patterns(histogram: dict[int, int], params: PackingParams = PackingParams()) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[((length, copies), ...), sequences] that place every piece of the histogram exactly: the
    roundings of the configuration program at four levels, the one with fewest sequences."""
    out = []
    rest = {n: c for n, c in histogram.items() if c > 0}
    full = rest.pop(params.capacity, 0)
    if full:
        out.append((((params.capacity, 1),), full))
    if rest:
        lengths = np.array(sorted(rest), np.int64)
        demand = np.array([rest[n] for n in lengths.tolist()], np.int64)
        found = sorted(fractional(lengths, demand.astype(float), params), key=lambda t: -t[1])
        tries = [rounded(lengths, demand, found, least, params.capacity) for least in (1, 8, 64, np.inf)]
        out += min(tries, key=lambda t: sum(many for _, many in t))
    return out


def places(found: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[str, np.ndarray]:
    """Where the k-th piece of a length goes: sorted ranges of k with their sequences."""
    rows, following, sequence = [], defaultdict(int), 0
    for pattern, many in found:
        offset = 0
        for length, copies in pattern:
            rows.append((length, following[length], copies, sequence, offset))
            following[length] += many * copies
            offset += length * copies
        sequence += many
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {n: table[:, i] for i, n in enumerate(("length", "first", "copies", "sequence", "offset"))}


def pack(found: DataFrame, params: PackingParams = PackingParams()) -> DataFrame:
    """``found`` (columns of ``PIECES_SCHEMA`` and any others) plus sequence_id and offset."""
    counts = {int(r["length"]): int(r["n"]) for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(patterns(counts, params))
    buckets = max(1, sum(counts.values()) // params.bucket_rows)
    # rank inside a length in two levels: inside a hash bucket, plus the buckets before it
    keyed = found.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("length", "_bucket", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = keyed.withColumn("_k", F.row_number().over(order).cast("long")).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_k", F.col("_k") - 1 + F.col("_before")).select(*found.columns, "_k")
    names = found.columns
    shift = 40

    def put(batches):
        keys = (table["length"] << shift) + table["first"]
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            k = batch.column(len(names)).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << shift) + k, side="right") - 1
            j, copies = k - table["first"][at], table["copies"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(table["sequence"][at] + j // copies), pa.array(table["offset"][at] + j % copies * length)],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(put, T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def best_fit_packing(docs: DataFrame, tokenizer_path: str, params: PackingParams = PackingParams()) -> DataFrame:
    """Every piece of every document (doc_id, text) with its sequence and its offset there."""
    scratch = C.Scratch(docs.sparkSession, "packing")
    return pack(scratch.keep(pieces(docs, tokenizer_path, params.capacity), "pieces"), params)
