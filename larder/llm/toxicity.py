"""Toxicity scores after noisy-channel deobfuscation.

1. A character trigram model is counted over every word of the corpus (a table of fixed size).
2. Suspicious spans of a text (leetspeak, masks, spaced-out letters, repeated letters) become
   lattices of intended letters and word boundaries; Viterbi decoding finds the likeliest intended string under channel
   costs and the character model.
3. Restored text is scored by a logistic model over words and word beginnings, fitted on a
   bounded sample of labelled training rows.

Defined results
    NULL or empty text: no features, so the score is that of the model's intercept.
    NULL doc_id: kept, never held out, carries no label.  Repeated rows: each is scored.
    Repeated labels of a document: the largest value counts.
    No labelled training rows, or only one class: every score is the share of toxic rows (0
    without any).  Empty table: empty result.  Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm import common as C

# ---------------------------------------------------------------------------------------
# character model: 26 letters, 26 = word boundary, 27 = any other letter
# ---------------------------------------------------------------------------------------

EDGE, OTHER, ALPHABET = 26, 27, 28
_FOLD = np.full(256, EDGE, np.int64)
_FOLD[97:123] = np.arange(26)
_FOLD[65:91] = np.arange(26)
_FOLD[128:] = OTHER


def _trigram_counts(batches):
    C.release()
    total = np.zeros(ALPHABET**3, np.int64)
    for _, data, offsets in C.chunks(batches, "text"):
        # a boundary in front of every document, so that no trigram crosses documents
        codes = np.insert(_FOLD[data], offsets[:-1], EDGE)
        codes = np.r_[EDGE, codes, EDGE]
        total += np.bincount((codes[:-2] * ALPHABET + codes[1:-1]) * ALPHABET + codes[2:], minlength=ALPHABET**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"trigram": pa.array(at), "n": pa.array(total[at])})


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over the whole corpus, shape (28, 28, 28), smoothed by shorter contexts."""
    rows = docs.select("text").mapInArrow(_trigram_counts, "trigram long, n long").groupBy("trigram").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(ALPHABET**3)
    n[rows["trigram"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    n = n.reshape(ALPHABET, ALPHABET, ALPHABET)
    one = (n.sum((0, 1)) + 1) / (n.sum() + ALPHABET)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    return np.log((n + 5 * two[None]) / (n.sum(2)[:, :, None] + 5))


# ---------------------------------------------------------------------------------------
# noisy channel
# ---------------------------------------------------------------------------------------

#: Letters that a sign commonly stands for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: A mask may hide any letter.
MASKS = "*"
SEPARATORS = " .-_*"
_SIGNS = re.escape("".join(LOOKALIKES) + MASKS)
_LETTER = r"[^\W\d_]"
_UNIT = rf"(?:{_LETTER}|[{_SIGNS}])"
#: Spans worth decoding, the first that fits at a place: three or more signs or letters set apart; ...
_APART = re.compile(rf"(?<![\w{_SIGNS}]){_UNIT}(?:[ .\-_]{{1,2}}{_UNIT}|\*(?!\*){_UNIT}){{2,}}(?!\w)")
_ANY_SIGN, _ONE_LETTER, _ONE_UNIT = re.compile(f"[{_SIGNS}]"), re.compile(_LETTER), re.compile(_UNIT)
_UNITS, _LETTERS, _TRIPLE = re.compile(f"{_UNIT}+"), re.compile(f"{_LETTER}+"), re.compile(r"([a-z])\1\1")
_TRIPLES = [c * 3 for c in "abcdefghijklmnopqrstuvwxyz"]


def _run_start(text: str, at: int, one: re.Pattern) -> int:
    while at and one.match(text, at - 1):
        at -= 1
    return at


def _signed_runs(text: str) -> Iterator[tuple[int, int]]:
    """... a whole run of signs and letters in which a sign stands next to a letter; ..."""
    end = -1
    for m in _ANY_SIGN.finditer(text):
        at = m.start()
        if at >= end and (_ONE_LETTER.match(text, at + 1) or at and _ONE_LETTER.match(text, at - 1)):
            start, end = _run_start(text, at, _ONE_UNIT), _UNITS.match(text, at).end()
            yield start, end


def _drawn_out_runs(text: str) -> Iterator[tuple[int, int]]:
    """... a whole run of letters with one of them three times in a row."""
    if not any(t in text for t in _TRIPLES):
        return
    end = -1
    for m in _TRIPLE.finditer(text):
        if m.start() >= end:
            start, end = _run_start(text, m.start(), _ONE_LETTER), _LETTERS.match(text, m.start()).end()
            yield start, end


def suspicious(text: str) -> Iterator[str]:
    """The spans of lower-case ``text`` worth decoding, from left to right, none inside another.  Signs are
    looked for first, so that plain words cost one pass of a character class."""
    kinds = [_signed_runs(text), _drawn_out_runs(text)]
    runs = [next(k, None) for k in kinds]
    apart, at = _APART.search(text), 0
    while True:
        if apart and apart.start() < at:
            apart = _APART.search(text, at)
        for i, k in enumerate(kinds):
            while runs[i] and runs[i][0] < at:
                runs[i] = next(k, None)
        first = min((x for x in ((apart.start(), 0, apart.end()) if apart else None, *((r[0], i + 1, r[1]) if r else None for i, r in enumerate(runs))) if x),
                    default=None)
        if first is None:
            return
        yield text[first[0]:first[2]]
        at = first[2]


_SPACED = re.compile(rf"{_UNIT}(?:[ .\-_]{{1,2}}{_UNIT}|\*(?!\*){_UNIT}){{2,}}")
LOG = {"same": 0.0, "sign": -0.7, "mask": -3.5, "drop": -14.0, "once": -0.3, "twice": -1.0, "single": -5.0,
       "edge": -8.0, "point": -2.0, "mask edge": -10.0, "space edge": -0.5, "between": -1.0}


def _edge(sign: str) -> float:
    """Log channel weight of a sign, or run of signs, that ends a word; letters never do."""
    if sign in SEPARATORS:
        return LOG["mask edge" if sign in MASKS else "space edge"]
    return LOG["point" if sign == "!" else "edge"] if sign in LOOKALIKES else -np.inf


def _options(sign: str, count: int) -> list[tuple[tuple[int, ...], float]]:
    """Intended letter sequences of ``count`` equal observed signs, with log channel weights."""
    if sign in SEPARATORS and sign not in MASKS:
        return [((), 0.0)]
    if "a" <= sign <= "z":
        letters, weight = [ord(sign) - 97], LOG["same"]
    elif sign in LOOKALIKES:
        letters, weight = [ord(c) - 97 for c in LOOKALIKES[sign]], LOG["sign"]
    elif sign in MASKS:
        return [((), LOG["drop"] / 2)]  # its letters are taken all at once
    else:
        return [((OTHER,), 0.0)]
    out = []
    for x in letters:
        if count == 1:
            out.append(((x,), weight))
        elif count == 2:
            out += [((x, x), weight), ((x,), weight + LOG["single"])]
        else:
            out += [((x,), weight + LOG["once"]), ((x, x), weight + LOG["twice"])]
    if not "a" <= sign <= "z":
        out.append(((), LOG["drop"] * count))
    return out


def _masked_end(a: int, b: int, masks: int, model: np.ndarray) -> tuple[float, str]:
    """(log weight, letters) of the likeliest end of a word after the letters a, b, of which at
    most ``masks`` letters are hidden: masks that hide none are dropped, or end the word."""
    spare = max(masks * LOG["drop"] / 2, LOG["mask edge"]) if masks else 0.0
    best, steps = (model[a, b, EDGE] + spare, ""), []
    value = model[a, b, :26][None]  # by the letter before (b alone at first) and the last letter
    for j in range(1, masks + 1):
        left = masks - j
        ends = value + (model[b, :26, EDGE][None] if j == 1 else model[:26, :26, EDGE])
        at = int(ends.argmax())
        score = float(ends.flat[at]) + j * LOG["mask"] + (max(left * LOG["drop"] / 2, LOG["mask edge"]) if left else 0.0)
        if score > best[0]:
            x, y = divmod(at, 26)
            letters = [y]
            for back in reversed(steps):
                letters.append(x)
                x, y = (int(back[x, y]) if back is not None else 0), x
            best = (score, "".join(chr(97 + c) for c in reversed(letters[:j])))
        if j < masks:
            # j + 1 letters: the best letter two before the last
            following = value[:, :, None] + (model[b, :26, :26][None] if j == 1 else model[:26, :26, :26])
            steps.append(None if j == 1 else following.argmax(0))
            value = following.max(0)
    return best


def restore(span: str, model: np.ndarray) -> str:
    """The likeliest intended words of an observed span.  Signs set apart have up to three readings:
    as one word, as words, and as one word after a word of one letter in front."""
    if not _SPACED.fullmatch(span):
        return _decode(span, model, False, True)
    found = [_decode(span, model, True, False), _decode(span, model, True, True)]
    rest = re.sub(r"^.[ .\-_*]+", "", span)
    if _SPACED.fullmatch(rest):
        found.append(_decode(rest, model, True, False))
    return " ".join(dict.fromkeys(w for f in found for w in f.split()))


def _decode(span: str, model: np.ndarray, spaced: bool, bounded: bool) -> str:
    """Viterbi over the lattice whose states are the last two letters; ``bounded``: separators may
    be word boundaries."""
    masks = 0 if spaced else len(span) - len(span.rstrip(MASKS))
    span = span[:len(span) - masks]
    runs, i = [], 0
    while i < len(span):
        j = i + 1
        # a mask hides a letter, so each counts; separators of any kind are one
        while j < len(span) and (span[j] == span[i] and span[i] not in MASKS or span[i] in " .-_" and span[j] in " .-_"):
            j += 1
        runs.append((span[i], j - i))
        i = j
    states: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    for k, (sign, count) in enumerate(runs):
        following: dict[tuple[int, int], tuple[float, tuple]] = {}

        def reach(x, y, s, p):
            best = following.get((x, y))
            if best is None or s > best[0]:
                following[(x, y)] = (s, p)

        options = _options(sign, count)
        if spaced and sign in MASKS and 0 < k < len(runs) - 1 and runs[k - 1][0] not in SEPARATORS:
            options = [((), LOG["between"])]
        for letters, weight in options:
            for (a, b), (score, path) in states.items():
                x, y, s, p = a, b, score + weight, path
                for c in letters:
                    s += model[x, y, c]
                    x, y, p = y, c, (p, sign if c == OTHER else chr(97 + c))
                reach(x, y, s, p)
        if sign in MASKS:
            before: dict[int, list] = {}
            for (a, b), (score, path) in states.items():
                before.setdefault(b, []).append((a, score + LOG["mask"], path))
            for b, many in before.items():
                scores = model[[m[0] for m in many], b, :26] + np.array([m[1] for m in many])[:, None]
                for c, at in enumerate(scores.argmax(0).tolist()):
                    reach(b, c, scores[at, c], (many[at][2], chr(97 + c)))
        if (weight := _edge(sign)) > -np.inf and (bounded or sign not in SEPARATORS):
            for (a, b), (score, path) in states.items():
                # signs that follow a boundary belong to it; further masks at no cost
                if path and path[1] == " ":
                    reach(a, b, score + (0.0 if sign in MASKS else weight), path)
                else:
                    reach(b, EDGE, score + weight + model[a, b, EDGE], (path, " "))
        states = following
    ends = []
    for (a, b), (score, path) in states.items():
        if path and path[1] == " ":
            ends.append((score, "", path))  # the word has ended already
        else:
            weight, hidden = _masked_end(a, b, masks, model)
            ends.append((score + weight, hidden, path))
    _, hidden, path = max(ends, key=lambda t: (t[0], t[1], str(t[2])))
    out = []
    while path:
        path, c = path
        out.append(c)
    return ("".join(reversed(out)) + hidden).strip()


class Restorer:
    """``restore`` with a bounded memory of spans already seen."""

    def __init__(self, model: np.ndarray, remember: int = 100_000):
        self.array, self.remember, self.seen = model, remember, {}

    def __call__(self, span: str) -> str:
        found = self.seen.get(span)
        if found is None:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            found = self.seen[span] = restore(span, self.array)
        return found


WORD = re.compile(r"[^\W\d_]+")


def restored_words(text: str, restorer: Restorer) -> list[str]:
    """The words of the whole text, then those that decoding restores from suspicious spans."""
    low = text.lower()
    found = WORD.findall(low)
    found += [w for span in suspicious(low) for w in WORD.findall(restorer(span))]
    return found


# ---------------------------------------------------------------------------------------
# scoring
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityParams:
    #: Bound on the labelled rows the score is fitted on (first by a hash of doc_id).
    max_labelled: int = 20_000
    #: Words and word beginnings in the model, the most telling of the training rows.
    features: int = 384
    beginnings: tuple[int, ...] = (4, 5, 6, 7)
    min_toxic_documents: int = 4
    ridge: float = 1.0
    #: Tasks that share the bounded sample.
    tasks: int = 32
    threshold: float = 0.3


def feature_counts(words: list[str], known: dict[str, int] | None, heads: frozenset[str] | None, beginnings: tuple[int, ...]) -> Counter:
    """How often each word (``=w``) and word beginning (``w[:k]``) occurs; with ``known``, only
    those of the model, found through the set of their four-letter heads."""
    out: Counter = Counter()
    for w, n in Counter(words if heads is None else [w for w in words if w[:4] in heads]).items():
        keys = ["=" + w, *(w[:k] for k in beginnings if len(w) >= k)]
        for k in dict.fromkeys(keys):
            if known is None or k in known:
                out[k] += n
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights, the last for the intercept: ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class ToxicityModel:
    """Everything a task needs: of fixed size whatever the corpus."""

    characters: np.ndarray
    known: dict[str, int]
    weights: np.ndarray
    beginnings: tuple[int, ...]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        restorer = Restorer(self.characters)
        return self._scores(texts, restorer, frozenset(k.lstrip("=")[:4] for k in self.known))

    def _scores(self, texts, restorer, heads) -> np.ndarray:
        out = np.full(len(texts), self.weights[-1])
        for i, text in enumerate(texts):
            if text:
                found = feature_counts(restored_words(text, restorer), self.known, heads, self.beginnings)
                out[i] += sum(self.weights[self.known[k]] * np.log1p(n) for k, n in found.items())
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def is_held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text leaves 2 modulo 4; NULL is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Character model over all of ``docs``; score model on the labelled rows that are not held
    out.  Only texts and labels are inputs."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "toxicity")
    characters = character_model(docs)
    marks = labels.where(~is_held_out()).select("doc_id", "toxic").na.drop().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = C.lowest_by_hash(marks, "doc_id", params.max_labelled).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.max_labelled)
    # at most max_labelled rows of two numbers: a bounded broadcast
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))  # one text per labelled id
    train = (docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").withColumn("rank", F.row_number().over(first))
             .where("rank = 1").select("text", "toxic"))
    train = scratch.keep(train.repartition(params.tasks, F.xxhash64("text")), "train")
    beginnings = params.beginnings

    def evidence(batches):
        restorer, found = Restorer(characters), {1: Counter(), 0: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[int(toxic > 0)].update(feature_counts(restored_words(text or "", restorer), None, None, beginnings).keys())
        # a feature that no toxic row has cannot pass min_toxic_documents in this task alone
        keys = list(found[1].keys() | found[0].keys())
        for at in range(0, len(keys), 100_000):
            part = keys[at:at + 100_000]
            yield pa.RecordBatch.from_pydict({"feature": pa.array(part), "bad": pa.array([found[1][k] for k in part], pa.int64()),
                                              "good": pa.array([found[0][k] for k in part], pa.int64())})

    totals = {int(r["bad"]): r["n"] for r in train.groupBy((F.col("toxic") > 0).cast("int").alias("bad")).agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = totals.get(1, 0), totals.get(0, 0)
    if not n_bad or not n_good:
        share = min(max(n_bad / max(n_bad + n_good, 1), 1e-9), 1 - 1e-9)
        return ToxicityModel(characters, {}, np.array([np.log(share / (1 - share))]), beginnings)
    share = F.lit(1.0) * (F.col("good") + 0.5) / (n_good + 1)
    rated = (train.mapInArrow(evidence, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .where(F.col("bad") >= params.min_toxic_documents)
             .withColumn("z", (F.col("bad") / n_bad - share) / F.sqrt(share * (1 - share) / n_bad + 1e-12)).where("z > 3")
             .orderBy(F.desc("z"), "feature").limit(params.features))
    known = {r["feature"]: i for i, r in enumerate(rated.collect())}
    heads = frozenset(k.lstrip("=")[:4] for k in known)

    def vectors(batches):
        restorer = Restorer(characters)
        for batch in batches:
            rows = [feature_counts(restored_words(t or "", restorer), known, heads, beginnings) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "at": pa.array([[known[k] for k in r] for r in rows], pa.list_(pa.int32())),
                "n": pa.array([list(r.values()) for r in rows], pa.list_(pa.int32())), "toxic": batch.column(1).cast(pa.int32())})

    sample: pd.DataFrame = train.mapInArrow(vectors, "at array<int>, n array<int>, toxic int").toPandas()
    x = np.zeros((len(sample), len(known)), np.float32)
    for i, (at, n) in enumerate(zip(sample["at"], sample["n"])):
        x[i, at] = np.log1p(n)
    weights = fit_logistic(x, (sample["toxic"].to_numpy() > 0).astype(float), params.ridge)
    scratch.close()
    return ToxicityModel(characters, known, weights, beginnings)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: toxicity of the whole text, 0 to 1."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches):
        C.release()
        restorer, heads = Restorer(model.characters), frozenset(k.lstrip("=")[:4] for k in model.known)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = model._scores(part.column(at).to_pylist(), restorer, heads)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, labels, params))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= params.threshold).cast("int").alias("predicted"))
