"""Rows of the token-group matrix: each set once, and pairs only where a first common shingle can be."""

from pyspark.sql import functions as F

from larder.llm import jaccard_join as J

PLACE = 3 << J.COARSE


def test_a_set_met_by_several_tasks_gives_its_rows_once(spark):
    """Copies met by many tasks would multiply the pairs of their shingles."""
    data = [(1, 10, PLACE + 4)] * 40 + [(1, 21, PLACE + 2)] * 40 + [(2, 10, PLACE + 5)] * 40
    found = J.shared_only(spark.createDataFrame(data, "token long, node long, last long").repartition(7)).collect()
    assert sorted(tuple(r) for r in found) == [(1, 10, False, PLACE, 4), (1, 20, True, PLACE, 2)]


def test_pairs_are_made_only_under_what_can_be_the_first_common_shingle(spark):
    """Sets of 100 need 86 in common, so the first common shingle is among the first 15 of both."""
    p = J.JoinParams()
    rows = [(100, 100, 100, qat, at) for qat in range(26) for at in range(15)] + [(100, 75, 75, 25, 0), (100, 75, 75, 25, 1)]
    df = spark.createDataFrame(rows, "qn long, low long, high long, qat long, at long").withColumn("ok", J.may_be_first(p))
    found = {tuple(r)[:5]: r["ok"] for r in df.collect()}
    assert all(found[100, 100, 100, qat, at] == (qat <= 14) for qat in range(26) for at in range(15))
    assert found[100, 75, 75, 25, 0] and not found[100, 75, 75, 25, 1]


def test_links_at_the_edge_are_kept(spark):
    """75 of 100 shingles in common, at any place of the order, still link; 74 do not."""
    words = [f"w{i}" for i in range(104)]
    texts = {i: " ".join(words[a:b]) for i, (a, b) in enumerate([(0, 104), (0, 79), (25, 104), (12, 91)])}
    other = [f"v{i}" for i in range(104)]
    texts |= {10: " ".join(other), 11: " ".join(other[:78])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in J.similar_components(docs, J.JoinParams(block=1)).select("doc_id", F.col("component_id")).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 10: 10, 11: 11}
