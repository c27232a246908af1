"""Toxicity, quality rules and personal data."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import pii as P
from larder.llm import quality_rules as Q
from larder.llm import toxicity as T

from . import brute as B

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_decoding_restores_disguised_words():
    words = "the idiot clown moron trash scum loser stupid pathetic is worthless and disgusting this that".split()
    codes = [26]
    for w in words * 50:
        codes += [ord(c) - 97 for c in w] + [26]
    n = np.zeros((28, 28, 28))
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        n[a, b, c] += 1
    for w in words:
        n[26, 26, ord(w[0]) - 97] += 50
    model = np.log((n + 0.01) / (n.sum(2, keepdims=True) + 0.28))
    for seen, meant in (("1d10t", "idiot"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"), ("p a t h e t i c", "pathetic"), ("stuuuupid", "stupid"),
                        ("tr@sh", "trash"), ("wor7hl3ss", "worthless"), ("cl*wn", "clown"), ("$cum", "scum"), ("1d1i0t", None)):
        found = T.restored_words(f"so {seen} it", T.Restorer(model))
        assert meant is None or meant in found, (seen, found)


def words_model(words):
    n = np.zeros((28, 28, 28))
    codes = [26]
    for w in words * 50:
        codes += [ord(c) - 97 for c in w] + [26]
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        n[a, b, c] += 1
    for w in words:
        n[26, 26, ord(w[0]) - 97] += 50
    return np.log((n + 0.01) / (n.sum(2, keepdims=True) + 0.28))


def test_decoding_of_signs_at_the_end_short_words_and_boundaries():
    restorer = T.Restorer(words_model("the fool ass hate shit idiot stupid trash a is so it that".split()))
    for seen, meant in (("a$$", "ass"), ("foo*", "fool"), ("f***", "fool"), ("hat3", "hate"), ("sh!+", "shit"), ("idi0+", "idiot"), ("a s s", "ass"),
                        ("you are a s t u p i d", "stupid"), ("s*t*u*p*i*d", "stupid"), ("t.r.a.s.h!", "trash"), ("i d i o t!", "idiot")):
        found = T.restored_words(f"so {seen} it", restorer)
        assert meant in found, (seen, found)
    # signs that only end a sentence hide nothing
    for seen in ("it!", "that!!!", "that***"):
        assert set(T.restored_words(seen, restorer)) == {seen.rstrip("!*")}, seen


def test_masks_at_the_end_hide_the_likeliest_letters():
    import itertools

    rng = np.random.default_rng(5)
    model = np.log(rng.dirichlet(np.full(28, 0.1), (28, 28)) + 1e-9)
    for a, b, masks in ((26, 3, 1), (4, 7, 2), (26, 26, 3), (0, 19, 3)):
        scores = {}
        for j in range(masks + 1):
            spare = max((masks - j) * T.LOG["drop"] / 2, T.LOG["mask edge"]) if j < masks else 0.0
            for letters in itertools.product(range(26), repeat=j):
                codes = (a, b, *letters, T.EDGE)
                scores["".join(chr(97 + c) for c in letters)] = spare + j * T.LOG["mask"] + sum(model[codes[i:i + 3]] for i in range(len(codes) - 2))
        score, hidden = T._masked_end(a, b, masks, model)
        assert hidden == max(scores, key=scores.get) and score == pytest.approx(scores[hidden])


def test_toxicity_on_held_out_rows(spark, corpus):
    docs, labels = corpus
    extra = docs.withColumn("score", F.lit(1)).withColumn("held_out", F.lit("x"))
    found = T.toxicity(extra, labels.select("doc_id", "toxic")).join(labels, "doc_id").toPandas()
    assert set(found["predicted"]) <= {0, 1} and found["score"].between(0, 1).all()
    train = found[~found["held_out"]]
    assert (train["predicted"] == (train["toxic"] > 0)).mean() > 0.9
    rest = found[found["held_out"]]
    bad, good = rest[rest["toxic"] == 1]["score"].to_numpy(), rest[rest["toxic"] == 0]["score"].to_numpy()
    assert ((bad[:, None] > good).mean() + 0.5 * (bad[:, None] == good).mean()) > 0.8


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (2, ""), (3, "word " * 20_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = T.toxicity(docs, none).collect()
    assert len(rows) == 5 and all(r["score"] < 0.001 and r["predicted"] == 0 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert T.toxicity(docs.limit(0), none).count() == 0
    labelled = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1)], "doc_id long, toxic int")
    assert T.toxicity(docs, labelled).count() == 5


def test_rule_statistics_equal_plain_counts(spark, corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus[0].limit(150).collect()]
    rows += [(None, None), (-1, ""), (-2, "a b c d e a b c d e\nx\nx\n \nx"), (-3, "é # € <|> word " * 3000), (-2, "a")]
    stats = Q.rule_statistics(spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_words int"))
    expected = []
    for doc_id, text in rows:
        text = text or ""
        w = B.words(text)
        five = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        again = set()
        for i in range(len(w) - 4):
            if five[tuple(w[i:i + 5])] > 1:
                again.update(range(i, i + 5))
        seen, dup = set(), 0
        for line in text.split("\n"):
            if B.words(line):
                dup += line in seen
                seen.add(line)
        expected.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)))
    assert B.in_order(stats.select("doc_id", *Q.COUNTS).collect()) == B.in_order(expected)


def test_quality_keeps_good_rows_and_rejects_odd_ones(spark, corpus):
    docs, labels = corpus
    found = Q.quality_rules(docs, labels).join(labels, "doc_id").where("not base_failed").toPandas()
    good = found[found["quality"] == 1]
    assert good["kept"].mean() > 0.98
    failed = Q.quality_rules(docs, labels).where("base_failed")
    assert failed.where("kept").count() == 0
    none = labels.limit(0)
    assert Q.quality_rules(docs, none).where("not base_failed and not kept").count() == 0
    assert Q.quality_rules(docs.limit(0), labels).count() == 0


def test_isolation_gives_outliers_short_paths():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(500, 3)), [[9, 9, 9]]])
    trees = [Q.grow_tree(x[rng.choice(501, 64, replace=False)], rng) for _ in range(100)]
    scores = Q.anomaly(x, trees, 64)
    assert scores.argmax() == 500


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and sum(
                    int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


TRICKY = ["a@b.c.d@e.f", "a@b@c.d x", "x@y", "1.2.3.4.5.6.7.8", "999.1.1.1 00255.1.2.3", "4111 1111-1111 1111", "4111111111111112", "+1 (509) 555-6973",
          "+1+1234567890", "+49 30 1234 5678 9012 3456", "é.x@ä.de a.b+c@d-e.fg.", "12 34", "@@..@", "", None, "1.1.1.1@2.2", "+1 2345 6789 1.2.3.4"]


def test_base_patterns_equal_regular_expressions(spark, corpus):
    rng = np.random.default_rng(1)
    letters = list("ab1290@.+- ()é")
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(100 + i, "".join(rng.choice(letters, 60))) for i in range(400)]
    rows += [(r["doc_id"] + 10_000, r["text"]) for r in corpus[0].collect()]
    found = P.personal_data(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")).collect()
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        spans = base(texts[r["doc_id"]])
        assert r["base_sha256"] == B.sha(P.named(spans)), (texts[r["doc_id"]], r, spans)
        assert set(filter(None, P.named(spans).split(","))) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]


def test_field_adds_like_mentions_and_redacts(spark):
    card = "4111 1111 1111 1111"
    rows = [(i, f"pay {card} now") for i in range(20)] + [(50 + i, f"call 12{i}34.5678.90{i}1 maybe") for i in range(20)]
    rows += [(100, f"first {card}, then 4111.1111.1111.1111 again"), (101, "mail joe.doe@mail.example.com or joe.doe (at) mail (dot) example (dot) com"),
             (102, "number 4111.1111.1111.1112 alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in P.personal_data(docs).collect()}
    assert found[100]["n_added"] == 1 and "card:32:51" in found[100]["spans"]
    assert found[101]["n_added"] == 1
    assert found[102]["n_added"] == 0
    texts = {r["doc_id"]: r["text"] for r in P.redacted(docs, P.fit(docs)).collect()}
    assert texts[100] == "first <card>, then <card> again"
    assert P.personal_data(docs.limit(0)).count() == 0


@pytest.mark.parametrize("said", ["joe.doe (at) mail (dot) org", "joe[at]mail[dot]org", "joe{at}mail.org", "Joe.Doe (AT) Mail (DOT) Org", "JOE AT MAIL DOT ORG"])
def test_spelled_out_addresses_alone_are_looked_at(spark, said):
    text = f"write to {said} soon"
    start = text.index(said)
    assert (P.NONE, start, start + len(said)) in P.open_candidates(text, [])
    assert P.content(said) in ("joe.doe@mail.org", "joe@mail.org")
    field = P.Field({}, np.array([9.0, 0, 0, 0, 0]), *(np.zeros((P.LABELS, P.LABELS)) for _ in range(3)))
    assert P.find(text, field) == ([], [(0, start, start + len(said))])
    assert P.redact(text, field) == "write to <email> soon"
    counts = P.evidence(spark.createDataFrame([(text,)], "text string")).where("what = 'prior'").collect()
    assert [(r["label"], r["n"]) for r in counts] == [(P.NONE, 1)]


def test_all_equal_mentions_of_a_long_document_agree(spark):
    card = "4111 1111 1111 1111"
    rows = [(i, f"pay {card} now") for i in range(20)] + [(50 + i, f"call 12{i}34.5678.90{i}1 maybe") for i in range(20)]
    field = P.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    for plain, other in ((card, "4111.1111.1111.1111"), ("joe.doe@mail.org", "joe.doe (at) mail (dot) org")):
        for many in (13, 40, 250):
            for text in (" and ".join([plain] + [other] * many), " and ".join([other] * many + [plain])):
                base, added = P.find(text, field)
                assert len(base) == 1 and len(added) == many and {k for k, _, _ in added} == {base[0][0]}, (plain, many, len(added))


def test_messages_pass_along_every_link():
    # thirty links without a word of their own: what the first says reaches the last
    agree = np.full((P.LABELS, P.LABELS), -9.0) + 18 * np.eye(P.LABELS)
    field = P.Field({}, np.zeros(P.LABELS), np.zeros((P.LABELS, P.LABELS)), agree, agree)
    clamped = np.r_[2, np.full(30, -1)]
    p = P.marginals(np.zeros((31, P.LABELS)), clamped, [(i, i + 1, "same") for i in range(30)], field, P.FieldParams())
    assert (p.argmax(1) == 2).all() and p[:, 2].min() > 0.9


def test_long_runs_of_signs_take_linear_time():
    for text in ("a" * 200_000, "*" * 20_000 + "a", " *" * 5_000, "a*" * 5_000, "!" * 100_000 + "a!", "a " * 5_000, "é" * 100_000):
        list(T.suspicious(text))


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+" * 100_000, "1." * 100_000, "@" * 100_000, "(at)" * 30_000):
        P.find(text, P.Field({}, np.zeros(5), *(np.zeros((5, 5)) for _ in range(3))))


def test_zero_padded_numbers_are_read_as_numbers():
    assert [s for s in P.base_spans("0" * 5000 + "1.1.1.1") if s[0] == 1] == [(1, 0, 5007)]
    assert [s for s in P.base_spans("9" * 5000 + ".1.1.1 and 0000.0.256.1") if s[0] == 1] == []
    assert [s for s in P.base_spans("000.0.0255.1") if s[0] == 1] == [(1, 0, 12)]


def test_repeated_words_are_counted_by_their_letters(spark):
    bits = [bin(i).count("1") % 2 for i in range(256)]
    one, two = ("".join(p[b] for b in bits) for p in ("ab", "ba"))
    rows = [(1, f"{one} b c d e {two} b c d e f g"), (2, f"{one} b c d e {one} b c d e f g")]
    stats = {r["doc_id"]: r["n_repeat_words"] for r in Q.rule_statistics(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert stats == {1: 0, 2: 10}


def test_suspicious_spans_equal_one_pattern():
    s, letter, unit = T._SIGNS, T._LETTER, T._UNIT
    whole = re.compile(rf"(?<![\w{s}]){unit}(?:[ .\-_]{{1,2}}{unit}|\*(?!\*){unit}){{2,}}(?!\w)"
                       rf"|(?<!{letter})(?<![{s}]){unit}*(?:[{s}]{letter}|{letter}[{s}]){unit}*|(?<!{letter})(?:{letter})*?([a-z])\1\1(?:{letter})*")
    rng = np.random.default_rng(1)
    for _ in range(5000):
        text = "".join(rng.choice(list("aab bé.-_*$1!2 \n,Ⅷaaa"), rng.integers(1, 40)))
        assert list(T.suspicious(text)) == [m[0] for m in whole.finditer(text)]
