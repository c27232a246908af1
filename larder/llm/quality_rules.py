"""Quality rules judged by an isolation forest on rule statistics.

One pass turns every whole text into rule statistics (counts and ratios).  Trees of random
splits are grown on small seeded subsamples of the labelled rows' statistics; a document's mean
path length over the trees gives its anomaly score, and the threshold is calibrated on the
labelled rows.  Trees and threshold are of fixed size and travel to the tasks; documents never
leave their partition except as one row of numbers.

Defined results
    NULL or empty text: no words, ``base_failed`` (fewer than 10 words), not kept.
    NULL doc_id: kept as NULL; such a row simply has no label.
    Repeated rows: each row gets its own result.  Repeated labels: the largest value counts.
    No usable label: the forest is grown on nothing and only the base rules decide.
    Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import common as C

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_CLASS = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 3 other ASCII punctuation
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_rate", "upper_rate", "digit_rate", "punct_rate",
            "distinct_rate", "repeat_rate", "dup_line_rate", "short_word_rate")
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in FEATURES)


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    #: Rows behind one tree: the subsample that the method itself prescribes.
    subsample: int = 24
    #: Bound on the labelled rows the forest and its threshold are fitted on.
    max_labelled: int = 50_000
    #: Share of the labelled good rows that the threshold may reject at most.
    max_good_loss: float = 0.004
    seed: int = 7


def _per_document(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    seen, found, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if not line.strip(b" \t\n\v\f\r"):
            continue
        lines += 1
        if line in seen:
            found += 1
        else:
            seen.add(line)
    return found, lines


def _repeats(hashes: np.ndarray) -> tuple[int, int]:
    """(words inside windows that occur twice or more, distinct words) of one document."""
    distinct = len(np.unique(hashes))
    windows = C.sequence_hashes(hashes, REPEAT_WINDOW)
    if len(windows) < 2:
        return 0, distinct
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0, distinct
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum()), distinct


def _statistics(batches):
    for part, data, offsets in C.chunks(batches, "text"):
        n = part.num_rows
        starts, ends, at = C.words(data, offsets)
        n_words = np.diff(at)
        hashes = C.word_hashes(data, starts, ends)
        space = C._SPACE[data]
        # continuation bytes 10xxxxxx are no code points of their own
        points = ((data & 0xC0) != 0x80) & ~space
        chars = _per_document(points, offsets)
        kinds = _CLASS[data]
        symbols = _per_document(_SYMBOL[data], offsets)
        short = _per_word(ends - starts <= 2, at)
        dup, lines, repeat, distinct = (np.zeros(n, np.int64) for _ in range(4))
        body = data.tobytes()
        for i in range(n):
            if n_words[i]:
                dup[i], lines[i] = _duplicate_lines(body[offsets[i]:offsets[i + 1]])
                repeat[i], distinct[i] = _repeats(hashes[at[i]:at[i + 1]])
        safe, size = np.maximum(n_words, 1), np.maximum(chars, 1)
        columns = dict(zip(COUNTS, (n_words, chars, symbols, dup, repeat)))
        columns |= dict(zip(FEATURES, (
            np.log1p(n_words), chars / safe, symbols / size, *(_per_document(kinds == k, offsets) / size for k in (1, 2, 3)),
            distinct / safe / np.maximum(1.0, safe / 100.0) ** -0.25, repeat / safe, dup / np.maximum(lines, 1), short / safe)))
        ids = part.column(part.schema.get_field_index("doc_id"))
        yield pa.RecordBatch.from_pydict({"doc_id": ids.cast(pa.int64())} | {k: pa.array(v) for k, v in columns.items()})


def _per_word(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _per_document(flags, at)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts and ratios per document (columns ``STATS_SCHEMA``)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_statistics, STATS_SCHEMA)


# ---------------------------------------------------------------------------------------
# forest
# ---------------------------------------------------------------------------------------


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random binary tree of n points."""
    n = np.asarray(n, float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """An isolation tree as arrays: feature (-1: leaf), cut, left child, leaf path length."""
    limit = math.ceil(math.log2(max(2, len(x))))
    feature, cut, left, path = [], [], [], []

    def add() -> int:
        for values, value in ((feature, -1), (cut, 0.0), (left, 0), (path, 0.0)):
            values.append(value)
        return len(feature) - 1

    todo = [(add(), np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        low, high = x[rows].min(0), x[rows].max(0)
        wide = np.flatnonzero(high > low)
        if len(rows) <= 1 or depth >= limit or not len(wide):
            path[node] = depth + float(_expected(len(rows)))
            continue
        f = int(rng.choice(wide))
        at = rng.uniform(low[f], high[f])
        a, b = add(), add()
        feature[node], cut[node], left[node] = f, at, a
        side = x[rows, f] <= at
        todo += [(a, rows[side], depth + 1), (b, rows[~side], depth + 1)]
    return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "path": np.array(path)}


def anomaly(x: np.ndarray, forest: list[dict], subsample: int) -> np.ndarray:
    """2 ** (-mean path / expected path): near 1 for points that few random splits isolate."""
    if not forest or not len(x):
        return np.zeros(len(x))
    total = np.zeros(len(x))
    for tree in forest:
        node = np.zeros(len(x), np.int64)
        while True:
            f = tree["feature"][node]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                break
            at = node[inner]
            node[inner] = tree["left"][at] + (x[inner, f[inner]] > tree["cut"][at])
        total += tree["path"][node]
    return 2.0 ** (-(total / len(forest)) / max(float(_expected(subsample)), 1e-9))


def fit_forest(x: np.ndarray, good: np.ndarray, params: ForestParams) -> tuple[list[dict], int, float]:
    """(trees, rows a tree saw, threshold).  The threshold is the lowest anomaly score that
    loses no more than ``max_good_loss`` of the labelled good rows that pass the base rules.
    Small subsamples keep groups of like anomalies from hiding one another."""
    if not good.any() or len(x) < 2:
        return [], 0, math.inf
    rng = np.random.Generator(np.random.PCG64(params.seed))
    size = min(params.subsample, len(x))
    forest = [grow_tree(x[rng.choice(len(x), size, replace=False)], rng) for _ in range(params.trees)]
    scores = np.sort(anomaly(x[good], forest, size))
    keep = min(len(scores) - 1, int(math.ceil(len(scores) * (1 - params.max_good_loss))))
    return forest, size, float(scores[keep])


def base_failed(n_words: str = "n_words", n_repeat: str = "n_repeat_words"):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat) > MAX_REPEAT_PERCENT * F.col(n_words))


def quality_verdicts(stats: DataFrame, labels: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """``stats`` plus ``anomaly``, ``base_failed`` and ``kept``.

    ``labels`` has (doc_id, quality).  Fitting reads at most ``max_labelled`` labelled rows that
    pass the base rules, the first in the order of a hash of doc_id."""
    marks = labels.select("doc_id", "quality").na.drop().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    marks = C.lowest_by_hash(marks, "doc_id", params.max_labelled)
    sample = (stats.where(~base_failed()).join(marks, "doc_id").select("quality", *FEATURES, F.xxhash64("doc_id").alias("h"), "doc_id")
              .orderBy("h", "doc_id", *FEATURES).limit(params.max_labelled).toPandas())
    x = sample[list(FEATURES)].to_numpy(float)
    forest, size, threshold = fit_forest(x, sample["quality"].to_numpy() == 1, params)
    names = stats.columns

    def score(batches):
        for batch in batches:
            x = np.column_stack([batch.column(names.index(f)).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly(x, forest, size))], [*names, "anomaly"])

    scored = stats.mapInArrow(score, STATS_SCHEMA + ", anomaly double")
    failed = base_failed()
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("anomaly") <= F.lit(threshold)))


def quality_rules(docs: DataFrame, labels: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """Statistics, anomaly score and verdict of every document of ``docs`` (doc_id, text)."""
    scratch = C.Scratch(docs.sparkSession, "quality")
    stats = scratch.keep(rule_statistics(docs), "stats")
    return quality_verdicts(stats, labels, params)
