"""Personal data: base patterns, and a skip-chain conditional random field that adds mentions.

Base matches of four kinds (email, ip, card, phone) are found by fixed patterns.  Looser
candidates (other separators, spelled-out signs, failing check digits) and the base matches of
one document are the nodes of a conditional random field.  Neighbouring nodes share a chain
potential; distant nodes with the same or similar content share a skip potential, so that all
mentions of one thing tend to one label.  Node and edge potentials are log ratios of counts over
the whole corpus; loopy message passing, until messages rest, gives marginals, and a candidate with
a likely kind is added.  Base matches are clamped, so they always stay.

Defined results
    NULL or empty text: no spans.  NULL doc_id: kept as NULL.  Repeated rows: each is answered.
    Ties between labels: the first kind as listed.  Empty table: empty result.  Further columns
    are ignored.  Every pattern is anchored so that its work is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import common as C

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = len(KINDS) + 1
SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")
CANDIDATES_SCHEMA = "doc_id long, base string, open string"

Span = tuple[int, int, int]  # kind (NONE for an open candidate), start, end in code points

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain: from each sign outwards, the local part not before the last match."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = max(free, at + 1)
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """Matches of the four base patterns in order of start, then kind."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(n) <= 3 and int(n or 0) <= 255 for n in (p.lstrip("0") for p in m[0].split("."))):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


# ---------------------------------------------------------------------------------------
# open candidates
# ---------------------------------------------------------------------------------------

_NUMBER = re.compile(r"(?<![A-Za-z0-9+])\+?[0-9](?:[ ().\-/_]{0,2}[0-9]){6,}(?![A-Za-z0-9])")
_AT = re.compile(r" ?[(\[{](?i:at)[)\]}] ?| ?[(\[{]@[)\]}] ?| @ | (?i:at) ")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?: ?[(\[{](?:(?i:dot)|\.)[)\]}] ?| (?i:dot) |\.)[A-Za-z0-9-]+)+")
#: Every base match and open candidate has one of these.
_GATE = re.compile(r"[0-9@]|[ (\[{][Aa][Tt][ )\]}]")


def open_candidates(text: str, base: list[Span]) -> list[Span]:
    """Looser mentions that touch no base match."""
    found = []
    if _DIGIT.search(text):
        found += [m.span() for m in _NUMBER.finditer(text)]
    if _GATE.search(text):
        for m in _AT.finditer(text):
            start, floor = m.start(), max(0, m.start() - 64)
            while start > floor and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            host = _HOST.match(text, m.end())
            # the bare word needs a spelled-out dot too, or it is ordinary prose
            if start < m.start() and host and (m[0].lower() != " at " or " dot " in host[0].lower()):
                found.append((start, host.end()))
    out, free = [], 0
    for start, end in sorted(found):
        if start >= free and not any(a < end and start < b for _, a, b in base):
            out.append((NONE, start, end))
            free = end
    return out


def content(text: str) -> str:
    """What a mention says, without its writing: digits only, or a lower-case address."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    if any(c.isalpha() for c in text):
        low = re.sub(r" ?[(\[{]at[)\]}] ?| ?[(\[{]@[)\]}] ?| at | @ ", "@", text.lower())
        return re.sub(r" ?[(\[{](?:dot|\.)[)\]}] ?| dot ", ".", low)
    return digits


def similarity_keys(text: str) -> list[str]:
    """Mentions that share a key are joined by a skip edge: same content, same address before
    the sign, or same last nine digits."""
    said = content(text)
    keys = ["=" + said]
    if "@" in said:
        keys.append("@" + said.split("@")[0])
    elif len(said) >= 9:
        keys.append("#" + said[-9:])
    return keys


def features(text: str) -> list[str]:
    """Shape features of a mention."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    groups = re.split(r"[^0-9]+", text)
    return [
        f"at{int('@' in text)}", f"letters{int(any(c.isalpha() for c in text))}", f"plus{int(text.startswith('+'))}",
        f"digits{min(len(digits), 20) // 2}", f"dots{min(text.count('.'), 4)}", f"groups{min(len(groups), 6)}",
        f"luhn{int(len(digits) >= 12 and luhn(digits))}",
        f"octets{int(len(groups) == 4 and all(g and len(g) < 4 and int(g) < 256 for g in groups))}",
        "signs" + "".join(sorted({c for c in text if not c.isalnum()}))[:6]]


# ---------------------------------------------------------------------------------------
# the field
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FieldParams:
    #: Rounds of all messages at once; what still changes then goes in sweeps along the document.
    rounds: int = 12
    damping: float = 0.3
    #: Messages that change by less are settled.
    settled: float = 1e-4
    #: A candidate is added when some kind has at least this marginal.
    accept: float = 0.6
    smoothing: float = 0.5
    #: Share of each feature's log ratio that counts.
    feature_share: float = 0.2
    #: Agreements believed before any count, between similar and between same mentions.
    similar_belief: float = 20.0
    same_belief: float = 5_000.0
    strongest: float = 12.0


@dataclass
class Field:
    """Log potentials: of a feature under each label, of the labels, of neighbours, of skips
    between similar mentions and between mentions with the same content."""

    unary: dict[str, np.ndarray]
    prior: np.ndarray
    chain: np.ndarray
    similar: np.ndarray
    same: np.ndarray

    def node(self, text: str) -> np.ndarray:
        return self.prior + sum((self.unary[f] for f in features(text) if f in self.unary), np.zeros(LABELS))


def edges(texts: list[str], clamped: np.ndarray | None = None) -> list[tuple[int, int, str]]:
    """(mention, later mention, kind of edge).  Skips join each mention to the previous one with
    the same key and, where ``clamped`` names base matches, each open one to the base matches next
    before and after it with the same key: what a base match says would fade on its way through
    open mentions.  Their number is linear in the mentions."""
    last: dict[str, int] = {}
    skips: dict[tuple[int, int], str] = {}
    keys = [similarity_keys(text) for text in texts]
    for i, own in enumerate(keys):
        for key in own:
            if key in last:
                skips.setdefault((last[key], i), "same" if key[0] == "=" else "similar")
            last[key] = i
    if clamped is not None:
        for order in (range(len(texts)), range(len(texts) - 1, -1, -1)):
            last = {}
            for i in order:
                for key in keys[i]:
                    if clamped[i] >= 0:
                        last[key] = i
                    elif key in last:
                        skips.setdefault((min(last[key], i), max(last[key], i)), "same" if key[0] == "=" else "similar")
    return [(i, i + 1, "chain") for i in range(len(texts) - 1)] + [(i, j, kind) for (i, j), kind in sorted(skips.items())]


def marginals(unary: np.ndarray, clamped: np.ndarray, joined: list[tuple[int, int, str]], field: Field, params: FieldParams) -> np.ndarray:
    """Loopy sum-product message passing; ``clamped`` is a label or -1 by node."""
    score = unary.copy()
    for i in np.flatnonzero(clamped >= 0):
        score[i] = -1e3
        score[i, clamped[i]] = 0
    a = np.array([e[0] for e in joined] + [e[1] for e in joined], np.int64)
    b = np.array([e[1] for e in joined] + [e[0] for e in joined], np.int64)
    if not len(a):
        p = np.exp(score - score.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)
    half = len(a) // 2
    tables = {"chain": field.chain, "similar": field.similar, "same": field.same}
    table = np.stack([tables[e[2]] for e in joined])
    table = np.concatenate([table, table.transpose(0, 2, 1)])
    message = np.zeros((len(a), LABELS))
    free = (clamped < 0)[b]  # nothing is told to a clamped node: many that disagree would outweigh it
    back = np.r_[np.arange(half, 2 * half), np.arange(half)]
    def passed(sent, tables):
        out = sent[:, :, None] + tables
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        return new - new.max(1, keepdims=True)

    moved = np.inf
    for _ in range(params.rounds):
        belief = score.copy()
        np.add.at(belief, b, message)
        new = passed(belief[a] - message[back], table) * free[:, None]
        moved = np.abs(new - message).max()
        message = params.damping * message + (1 - params.damping) * new
        if moved < params.settled:
            break
    if moved >= params.settled:
        # there and back along the document: a sweep reaches every link; steps get shorter every
        # ``rounds`` sweeps, so that messages that swing come to rest too
        order = np.argsort(a, kind="stable")
        ways = []
        for mine in (order[free[order] & (order < half)], order[free[order] & (order >= half)]):
            at = np.searchsorted(a[mine], np.arange(len(score) + 1))
            ways.append([(i, mine[at[i]:at[i + 1]]) for i in range(len(score)) if at[i] < at[i + 1]])
        ways[1].reverse()
        sweep = 0
        while moved >= params.settled:
            step, moved = (1 - params.damping) * 0.5 ** (sweep // params.rounds), 0.0
            belief = score.copy()
            np.add.at(belief, b, message)
            for way in ways:
                for i, out in way:
                    change = step * (passed(belief[i] - message[back[out]], table[out]) - message[out])
                    message[out] += change
                    np.add.at(belief, b[out], change)
                    moved = max(moved, np.abs(change).max())
            sweep += 1
    belief = score.copy()
    np.add.at(belief, b, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _code(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _spans(code: str) -> list[Span]:
    return [tuple(map(int, s.split(":"))) for s in code.split(",")] if code else []


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


def evidence(docs: DataFrame) -> DataFrame:
    """Counts over the corpus behind the potentials: (what, key, label, other, n)."""

    def run(batches):
        unary, prior, pairs = Counter(), Counter(), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or not _GATE.search(text):
                    continue
                base = base_spans(text)
                nodes = sorted(base + open_candidates(text, base), key=lambda s: (s[1], s[0]))
                texts = [text[a:b] for _, a, b in nodes]
                for (kind, _, _), said in zip(nodes, texts):
                    prior[kind] += 1
                    unary.update((f, kind) for f in features(said))
                # only pairs of base matches say how the labels of like mentions agree
                pairs.update((what, nodes[i][0], nodes[j][0]) for i, j, what in edges(texts)
                             if what == "chain" or NONE not in (nodes[i][0], nodes[j][0]))
        rows = [("unary", f, k, 0, n) for (f, k), n in unary.items()] + [("prior", "", k, 0, n) for k, n in prior.items()]
        rows += [(what, "", i, j, n) for (what, i, j), n in pairs.items()]
        if rows:
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["what", "key", "label", "other", "n"])

    return (docs.select("text").mapInArrow(run, "what string, key string, label int, other int, n long")
            .groupBy("what", "key", "label", "other").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, params: FieldParams = FieldParams()) -> Field:
    """Potentials from the counts of all of ``docs``.  The number of features is bounded by the
    shapes that ``features`` can name, so the collected table is small whatever the corpus."""
    s = params.smoothing
    prior = np.full(LABELS, s)
    pairs = {what: np.full((LABELS, LABELS), s) for what in ("chain", "similar", "same")}
    unary: dict[str, np.ndarray] = defaultdict(lambda: np.full(LABELS, s))
    for r in evidence(docs).collect():
        if r["what"] == "unary":
            unary[r["key"]][r["label"]] += r["n"]
        elif r["what"] == "prior":
            prior[r["label"]] += r["n"]
        else:
            pairs[r["what"]][r["label"], r["other"]] += r["n"]
    label = prior / prior.sum()

    def agree(counts: np.ndarray, belief: float) -> np.ndarray:
        # a prior belief that like mentions agree, then what the corpus says of base matches
        counts = counts + counts.T + np.eye(LABELS) * belief
        return np.log(counts / counts.sum() / np.outer(label, label)).clip(-params.strongest, params.strongest)

    chain = pairs["chain"]
    lift = chain * chain.sum() / np.outer(chain.sum(1), chain.sum(0))
    # features all describe one string, far from independent: their logs are averaged in part
    return Field({f: params.feature_share * np.log(n / prior) for f, n in unary.items()}, np.log(label), params.feature_share * np.log(lift),
                 agree(pairs["similar"], params.similar_belief), agree(pairs["same"], params.same_belief))


def find(text: str | None, field: Field, params: FieldParams = FieldParams()) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of one whole text."""
    if not text or not _GATE.search(text):
        return [], []
    base = base_spans(text)
    more = open_candidates(text, base)
    if not more:
        return base, []
    nodes = sorted(base + more, key=lambda s: (s[1], s[0]))
    texts = [text[a:b] for _, a, b in nodes]
    clamped = np.array([k if k != NONE else -1 for k, _, _ in nodes])
    p = marginals(np.stack([field.node(t) for t in texts]), clamped, edges(texts, clamped), field, params)
    added = []
    for i in np.flatnonzero(clamped < 0):
        kind = int(p[i, :NONE].argmax())
        if p[i, kind] >= params.accept:
            added.append((kind, nodes[i][1], nodes[i][2]))
    return base, added


def personal_data(docs: DataFrame, params: FieldParams = FieldParams()) -> DataFrame:
    """Counts and spans of every document of ``docs`` (doc_id, text)."""
    field = fit(docs, params)

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, added = find(text, field, params)
                count = Counter(k for k, _, _ in base)
                rows.append((doc_id, *(count[k] for k in range(NONE)), hashlib.sha256(named(base).encode()).hexdigest(), named(base + added), len(added)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def redact(text: str | None, field: Field, params: FieldParams = FieldParams()) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans
    become one, named after the first."""
    base, added = find(text, field, params)
    if not base and not added:
        return text
    out, at = [], 0
    reach = -1
    for kind, start, end in sorted(base + added, key=lambda s: (s[1], s[0], s[2])):
        if start < reach:
            if end > reach:
                at = reach = end
            continue
        out += [text[at:start], f"<{KINDS[kind]}>"]
        at = reach = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, field: Field, text: str = "text", params: FieldParams = FieldParams()) -> DataFrame:
    """``docs`` with ``text`` redacted; all columns and rows stay."""
    at, schema = docs.columns.index(text), docs.schema

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([redact(t, field, params) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, schema)
