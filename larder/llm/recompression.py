"""Repeated word windows found by recompression.

Words are the first symbols.  Each round collapses runs of one symbol and then replaces pairs: a
coin drawn from a symbol's own name puts it in the left or the right half of the alphabet, and
every left symbol followed by a right one becomes a new symbol named after the two.  Names are
content hashes, so equal word strings get equal interior symbols on every executor without a
dictionary.  Spark counts the symbols of the last round over the whole corpus: a window that holds
a symbol which occurs once cannot occur twice.  Windows all of whose certain symbols are shared
(or that hold none) are named by 96 bits of their words and counted, which verifies them.

A symbol is certain for a window when the words that decide about it all lie inside: every symbol
carries the word interval it depends on.

Defined results
    NULL or empty text: no words, nothing removed, hash of the empty string.  NULL doc_id: kept.
    Repeated rows: exact copies remove each other (if they have a window).  Texts shorter than a
    window lose nothing.  Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import common as C


@dataclass(frozen=True)
class RecompressionParams:
    window: int = 35
    rounds: int = 5
    #: Bits of the bitmap of shared symbols (4 MiB, whatever the corpus).
    bits: int = 1 << 25


_FAR = np.int64(1) << np.int64(40)


def symbols(hashes: np.ndarray, at: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first, end) of the symbols after ``rounds`` rounds over the words of all documents;
    first..end is the interval of words that decides about the symbol (beyond the document where
    its border decides)."""
    n = len(hashes)
    name = hashes.copy()
    first = np.arange(n, dtype=np.int64)
    end = first + 1
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for r in range(rounds):
        if not len(name):
            break
        # runs: one symbol, whatever the length, so a run cut by a window's edge keeps its name
        head = np.r_[True, (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])]
        if not head.all():
            at_head = np.flatnonzero(head)
            tail = np.r_[at_head[1:], len(name)] - 1
            name, owner, first, end = name[at_head], owner[at_head], first[at_head], end[tail]
        right = (C.mix(name + C._COEF[100 + r]) >> np.uint64(63)).astype(bool)
        follows = np.r_[owner[1:] == owner[:-1], False]
        joins = np.r_[~right[:-1] & right[1:], False] & follows
        joined = np.r_[False, joins[:-1]]
        new_first, new_end = first.copy(), end.copy()
        # a left symbol depends on its successor, a right one on its predecessor
        nxt = np.where(follows, np.r_[end[1:], 0], _FAR)
        new_end = np.where(right, new_end, np.maximum(new_end, nxt))
        before = np.r_[False, follows[:-1]]
        prv = np.where(before, np.r_[0, first[:-1]], -_FAR)
        new_first = np.where(right, np.minimum(new_first, prv), new_first)
        pairs = np.flatnonzero(joins)
        name = name.copy()
        fresh = C.mix(name[pairs] * C._COEF[200] + name[pairs + 1] * C._COEF[201])
        new_end[pairs] = end[pairs + 1]
        name[pairs] = fresh
        keep = ~joined
        name, owner, first, end = name[keep], owner[keep], new_first[keep], new_end[keep]
    return name, first, end


def _parts(batches):
    """(bytes, offsets, two lists of word hashes, word offsets, texts met) of each chunk."""
    seen = C.Seen()
    for _, data, offsets in C.chunks(batches, "text"):
        starts, ends, at = C.words(data, offsets)
        yield data, offsets, C.word_hashes(data, starts, ends), C.word_hashes(data, starts, ends, 1), at, seen


def shared_symbols(docs: DataFrame, params: RecompressionParams) -> np.ndarray:
    """Bitmap of the last round's names that occur twice or more in the corpus."""
    rounds = params.rounds

    def run(batches):
        for _, _, hashes, _, at, _ in _parts(batches):
            name, n = np.unique(symbols(hashes, at, rounds)[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"name": pa.array(C.signed(name)), "n": pa.array(n.astype(np.int32))})

    counts = docs.select("text").mapInArrow(run, "name long, n int").groupBy("name").agg(F.sum("n").alias("n"))
    return C.bitmap(counts.where("n > 1"), "name", params.bits)


def candidate_windows(docs: DataFrame, marks: np.ndarray, params: RecompressionParams) -> DataFrame:
    """(w1, w2, t1, t2, start): windows that no certain symbol rules out."""
    width, rounds = params.window, params.rounds

    def run(batches):
        for data, offsets, hashes, again, at, seen in _parts(batches):
            inside = C.starts_inside(at, width, len(hashes))
            total = len(inside)
            if not total:
                continue
            name, first, end = symbols(hashes, at, rounds)
            single = ~C.in_bitmap(marks, name) & (end - first <= width)
            low, high = np.maximum(end[single] - width, 0), np.minimum(first[single], total - 1)
            some = low <= high
            out = np.bincount(low[some], minlength=total + 1) - np.bincount(high[some] + 1, minlength=total + 1)
            alive = np.flatnonzero(inside & (np.cumsum(out)[:total] == 0))
            if not len(alive):
                continue
            body = data.tobytes()
            owner = np.searchsorted(at, alive, side="right") - 1
            t1, t2 = np.zeros(len(alive), np.int64), np.zeros(len(alive), np.int64)
            keep = np.zeros(len(alive), bool)
            edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for a, b in zip(edge, np.r_[edge[1:], len(alive)]):
                text = C.digest(body[offsets[owner[a]]:offsets[owner[a] + 1]])
                if not seen.again(text):
                    t1[a:b], t2[a:b] = text
                    keep[a:b] = True
            alive, owner = alive[keep], owner[keep]
            # the second name rests on word names of its own
            w1, w2 = C.sequence_hashes(hashes, width, 1), C.sequence_hashes(again, width, 3)
            yield pa.RecordBatch.from_pydict({
                "w1": pa.array(C.signed(w1[alive])), "w2": pa.array((w2[alive] >> np.uint64(32)).astype(np.uint32).view(np.int32)), "t1": pa.array(t1[keep]), "t2": pa.array(t2[keep]),
                "start": pa.array((alive - at[owner]).astype(np.int32))})

    return docs.select("text").mapInArrow(run, "w1 long, w2 int, t1 long, t2 long, start int")


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge)[:n] > 0


def kept_words(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def substring_dedup(docs: DataFrame, params: RecompressionParams = RecompressionParams()) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    scratch = C.Scratch(docs.sparkSession, "recompression")
    width = params.window
    whole = scratch.keep(C.copies(docs, lambda t: len(t.split()), width).select("t1", "t2"), "whole")
    marks = shared_symbols(docs, params)
    # read twice: naming windows again costs less than keeping them
    windows = candidate_windows(docs, marks, params)
    # counted with partial sums, so a window of a third of all documents is one row a task
    twice = scratch.keep(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2"), "twice")
    found = windows.join(twice, ["w1", "w2"], "left_semi").groupBy("t1", "t2").agg(F.collect_list("start").alias("found"))
    covered = scratch.keep(found.join(whole, ["t1", "t2"], "left_anti"), "covered")
    scratch.drop("twice")

    def removed(text: bytes, found) -> tuple[tuple[int, ...], str]:
        words = text.split()
        gone = _covered(found.to_numpy(zero_copy_only=False).astype(np.int64), width, len(words))
        kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
        return (int(gone.sum()),), hashlib.sha256(kept).hexdigest()

    out = C.finish(docs, whole, covered, removed, lambda t: len(t.split()), kept_words, ("n_removed",))
    return out.withColumnRenamed("size", "n_words")
