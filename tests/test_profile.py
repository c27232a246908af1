import pytest

from larder.operators import profile


def test_cardinality_counts_null_as_value(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "s string")
    assert [tuple(r) for r in profile.cardinality(df).collect()] == [("s", 3)]


def test_correlation_null_as_zero_and_constant(spark):
    df = spark.createDataFrame([(1, 2.0, 7), (2, None, 7), (3, 5.0, 7), (4, 1.0, 7)], "x int, y double, k int")
    got = {r.pair: r.corr for r in profile.correlations(df).collect()}
    assert got["x__y"] == pytest.approx(0.11952286093343936, abs=1e-12)
    assert got["x__k"] is None and got["y__k"] is None


def test_missing_percentage(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert {r.column_name: r.missing_pct for r in profile.missing_percentage(df).collect()} == {"a": 0.0, "b": 66.67}
    empty = spark.createDataFrame([], "a int")
    assert [r.missing_pct for r in profile.missing_percentage(empty).collect()] == [None]


def test_numeric_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "s", 1), (3, 4.0, "t", 2)], "a int, b double, c string, d smallint")
    row = profile.numeric_profile(df).first().asDict()
    assert sorted(row) == sorted(f"{c}_{m}" for c in "ab" for m in ("minimum", "maximum", "avg", "std"))
    assert (row["a_minimum"], row["a_maximum"], row["a_avg"]) == (1, 3, 2.0)
    none = spark.createDataFrame([("x",)], "c string")
    assert profile.numeric_profile(none).count() == 0


def test_basic_profile(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    rows = [tuple(r) for r in profile.basic_profile(df).collect()]
    assert rows == [("a", "bigint", 1, 1, 2), ("b", "string", 2, 1, 2)]


def test_states_of_parts_merge_to_the_profile_of_all(spark):
    import random

    rnd = random.Random(2)
    rows = [(rnd.choice("abc"), rnd.randint(-5, 5), None if rnd.random() < 0.2 else rnd.gauss(1e6, 1), 7, None) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, x int, y double, z long, w double").repartition(5)
    states = profile.merge_moments(profile.moments(df, by="k"), by_part=True)
    assert states.count() == 3
    found = {r["column_name"]: r for r in profile.numeric_profile_of(profile.merge_moments(states)).collect()}
    whole = profile.numeric_profile(df).head()
    for c in "xyzw":
        for name, key in (("minimum", "minimum"), ("maximum", "maximum"), ("avg", "avg"), ("std", "std")):
            a, b = found[c][name], whole[f"{c}_{key}"]
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-9)
        assert found[c]["missing"] == df.where(f"{c} IS NULL").count()
    pairs = {r["pair"]: r["corr"] for r in profile.correlations_of(profile.merge_moments(states)).collect()}
    direct = {r["pair"]: r["corr"] for r in profile.correlations(df).collect()}
    assert pairs.keys() == direct.keys()
    assert all((pairs[k] is None and direct[k] is None) or pairs[k] == pytest.approx(direct[k], abs=1e-9) for k in pairs)
