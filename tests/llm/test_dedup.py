"""Suffix, recompression and similarity operators against plain counting."""

import random

import pytest

from larder.llm import jaccard_join as J
from larder.llm import recompression as R
from larder.llm import suffix_dedup as S

from . import brute as B

SCHEMA = "doc_id long, text string, t1 long, found string, node long, root long, n long, kept_id string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, "y") for r in rows], SCHEMA).repartition(3)


def texts(seed, unit, sep):
    rnd = random.Random(seed)
    base = [rnd.choice(unit) for _ in range(300)]
    j = sep.join
    return [
        (1, None), (2, ""), (3, j(base)), (3, j(base)), (4, j(base[50:140])), (5, "x\ty\n" + j(base[100:190]) + " z"), (6, j(["a"] * 100)),
        (7, j(["a"] * 34 + base[:60])), (8, j(["q"] * 40 + base[200:234])), (None, j(base[10:44] + base[10:45])), (9, j(["a", "b"] * 60)),
        (10, j(base[:34])), (11, j(["b", "a"] * 20 + base[270:300] + ["m"])), (12, j(["a"] * 31 + list("klmn"))),
        (13, j(["a"] * 700 + list("klmn"))), (14, j(base[:140] + ["Z"] + base[141:])), (15, "é" * 400 + j(base[5:90])), (None, None)]


def test_word_windows_equal_counting(spark):
    rows = texts(1, [f"w{i}" for i in range(400)], " ")
    found = R.substring_dedup(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert B.in_order(found) == B.in_order(B.removed_windows(rows, 35))


@pytest.mark.parametrize("params", [S.SuffixParams(), S.SuffixParams(name_stretches=1), S.SuffixParams(batch_bytes=1000, shards=3, stretch=64)])
def test_byte_strings_equal_counting(spark, params):
    rows = texts(2, list("abcdefgh é") + ["word", "ß中"], "")
    found = S.substring_dedup(frame(spark, rows), params).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert B.in_order(found) == B.in_order(B.removed_bytes(rows, 200))


def test_merged_transforms_find_repeats_in_order():
    rnd = random.Random(5)
    base = bytes(rnd.choice(b"ab") for _ in range(2000))
    bodies = [base[:700], base[300:900], base[1000:1300], base[650:1100], b"c" * 450]
    import numpy as np

    got = S.repeated_starts(bodies, np.ones(len(bodies)), S.SuffixParams(shards=3))
    every = [b[i:i + 200] for b in bodies for i in range(len(b) - 199)]
    expected = [[i for i in range(len(b) - 199) if every.count(b[i:i + 200]) > 1] for b in bodies]
    assert [g.tolist() for g in got] == expected


def test_windows_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = R.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert B.in_order(found) == B.in_order(B.removed_windows(rows, 35))
    found = S.substring_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert B.in_order(found) == B.in_order(B.removed_bytes(rows, 200))


def similar_rows():
    rnd = random.Random(2)
    vocabulary = [f"W{i}" for i in range(500)]
    base = [rnd.choice(vocabulary) for _ in range(80)]
    rows = [(1, None), (2, ""), (3, " \t "), (4, "a b"), (5, "A  B"), (6, "a b c d e"), (None, "a b c d"), (7, "a b c d"), (8, "a b c"),
            (5, "a b"), (5, "zz yy xx"), (None, None)]
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(80)] = f"x{rnd.random()}"
        rows.append((100 + i, " ".join(w)))
    line = " ".join(vocabulary[:12])
    return rows + [(1000 + i, line + "\n" + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40)))) for i in range(150)]


@pytest.mark.parametrize("params", [J.JoinParams(), J.JoinParams(block=16, queries=7, crowded_groups=5)])
def test_components_equal_all_pairs(spark, params):
    rows = similar_rows()
    found = J.similar_components(frame(spark, rows), params).collect()
    assert B.in_order(found) == B.in_order(B.similar(rows))


def test_one_document_of_each_group_stays(spark):
    rows = similar_rows() + [(4, "a b")]
    kept = J.one_of_each(frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    got = B.in_order((r["doc_id"], B.shingles(r["text"]) and hash(B.shingles(r["text"]))) for r in kept.collect())
    first = {}
    empty = []
    for (doc_id, text), (_, n, component) in zip(rows, B.similar(rows)):
        if not n:
            empty.append((doc_id, frozenset()))
        elif doc_id == component:
            first.setdefault((doc_id, hash(B.shingles(text))), None)
    # a component's smallest id may belong to rows of several sets; one of them stays
    assert {g[0] for g in got if g[1]} == {k[0] for k in first}
    assert sum(1 for g in got if not g[1]) == len(empty)
    components = {(c, n > 0) for _, n, c in B.similar(rows) if n}
    assert sum(1 for g in got if g[1]) >= len(components) - 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.substring_dedup(none).count() == S.substring_dedup(none).count() == J.similar_components(none).count() == J.one_of_each(none).count() == 0


def thue_morse(n):
    """Two words of n letters that collide under every polynomial modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [8, 16, 64, 255, 256, 257, 2048])
def test_words_that_collide_under_polynomials_differ(spark, n):
    one, two = thue_morse(n)
    rows = [(1, " ".join([one] * 5)), (2, " ".join([two] * 5)), (3, " ".join([one, "x"] * 30)), (4, " ".join([two, "x"] * 30)),
            (5, " ".join(f"{one} {two} q{i}" for i in range(6)))]
    found = J.similar_components(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert B.in_order(found) == B.in_order(B.similar(rows))
    found = R.substring_dedup(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert B.in_order(found) == B.in_order(B.removed_windows(rows, 35))


def test_word_names_follow_the_bytes():
    import numpy as np

    from larder.llm import common as C

    rnd = random.Random(9)
    words = sorted({bytes(rnd.choice(b"ab\xc3\xa9") for _ in range(rnd.choice([1, 7, 8, 9, 15, 16, 17, 31, 40, 255, 256, 257, 300]))) for _ in range(3000)})
    names = []
    for sep in (b" ", b"\n\t "):
        data = np.frombuffer(sep.join(words), np.uint8)
        starts, ends, _ = C.words(data, np.array([0, len(data)]))
        assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == words
        names.append(C.word_hashes(data, starts, ends))
        assert len(np.unique(names[-1])) == len(words)
        assert not (names[-1] == C.word_hashes(data, starts, ends, 1)).any()
    assert (names[0] == names[1]).all()
