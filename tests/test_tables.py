"""Inferred CSV types, de-duplication by digests, and distinct counts by one narrow shuffle and by sketches."""

import pytest
from pyspark.sql import functions as F

from larder.operators import clean, profile
from larder.sources import files


def types_of(df):
    return {r.column_name: r.data_type for r in df.collect()}


def test_inferred_types_and_bad_lines(spark, tmp_path):
    lines = ["n,x,flag,day,at,word,mixed,none,big,sp ace`d",
             "1,1.5,true,2024-01-02,2024-01-02 03:04:05,a,1,,1,7",
             "-2,3,FALSE,2024-02-29,2024-01-03,1x,2.5,,99999999999999999999,8",
             "3,1e3,false,2024-12-31,2024-01-02T03:04:05.25,,2024-01-01,,3,9",
             "4,too,few", "5,1,true,2024-01-02,2024-01-02,b,4,,5,6,one too many"]
    path = str(tmp_path / "a.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    texts = files.csv_texts(spark, path)
    assert types_of(files.infer_types(texts)) == {
        "n": "bigint", "x": "double", "flag": "boolean", "day": "date", "at": "timestamp_ntz", "word": "string",
        "mixed": "string", "none": "string", "big": "double", "sp ace`d": "bigint"}
    out = files.read_inferred(spark, path)
    assert dict(out.dtypes) | {"_bad_row": "string"} == dict(out.dtypes)
    assert dict(out.dtypes)["n"] == "bigint" and dict(out.dtypes)["at"] == "timestamp_ntz"
    rows = out.collect()
    assert sorted(r["_bad_row"] for r in rows if r["_bad_row"]) == sorted(lines[4:])
    good = [r for r in rows if r["_bad_row"] is None]
    assert sorted((r["n"], r["x"], r["big"], r["sp ace`d"]) for r in good) == [(-2, 3.0, 1e20, 8), (1, 1.5, 1.0, 7), (3, 1000.0, 3.0, 9)]
    with pytest.raises(ValueError):
        files.csv_texts(spark, path, bad_row="n")


def test_inferred_types_use_one_scan_and_bad_dates_are_text(spark, tmp_path):
    path = str(tmp_path / "b.csv")
    with open(path, "w") as f:
        f.write("day,at\n2024-02-30,2024-01-01 25:00:00\n2024-01-01,2024-01-01 05:00:00\n")
    found = files.infer_types(files.csv_texts(spark, path))
    assert types_of(found) == {"day": "string", "at": "string"}
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan csv") == 1
    empty = str(tmp_path / "c.csv")
    with open(empty, "w") as f:
        f.write("a,b\n")
    assert dict(files.read_inferred(spark, empty).dtypes) == {"a": "string", "b": "string", "_bad_row": "string"}
    assert files.read_inferred(spark, empty).count() == 0


def test_dedupe_wide_equals_dedupe(spark):
    rows = [("a" * 500, None, 1.0), ("a" * 500, None, 1.0), (None, "a" * 500, 1.0), (None, None, None), (None, None, None),
            ("b", "c", 0.0), ("b", "c", -0.0), ("b", "c", float("nan")), ("b", "c", float("nan")), ("single", "", 2.0)]
    df = spark.createDataFrame(rows, "x string, `y z` string, w double")
    key = lambda d: sorted(map(str, d.collect()))
    assert key(clean.dedupe_wide(df).withColumn("w", F.abs("w"))) == key(clean.dedupe(df).withColumn("w", F.abs("w")))
    assert clean.dedupe_wide(df.limit(0)).count() == 0
    assert clean.dedupe_wide(df.unionByName(df).unionByName(df)).count() == clean.dedupe(df).count()
    with pytest.raises(ValueError):
        clean.dedupe_wide(df.withColumnRenamed("x", "_row_digest"))


def test_dedupe_wide_keeps_rows_that_share_a_digest(spark):
    # NULLs leave a row digest as it is, so these two rows have one
    df = spark.createDataFrame([("v", None), (None, "v")], "x string, y string")
    assert df.select(F.xxhash64("x", "y")).distinct().count() == 1
    assert clean.dedupe_wide(df).count() == 2


def test_cardinality_counts_long_values_and_null(spark):
    long = "q" * 70
    rows = [(long, "a"), (long + "1", "a"), (long, None), (None, "b"), ("", "b"), ("#" + long[:64], "c"), ("q" * 64, "c")]
    df = spark.createDataFrame(rows, "l string, `s t` string")
    assert {r.column_name: r.n_distinct for r in profile.cardinality(df).collect()} == {"l": 6, "s t": 4}
    assert {r.column_name: r.n_distinct for r in profile.cardinality(df.limit(0)).collect()} == {"l": 0, "s t": 0}
    plan = profile.cardinality(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_sketches_merge_over_parts(spark):
    df = spark.range(20_000).select((F.col("id") % 7).cast("string").alias("day"), (F.col("id") % 3000).cast("string").alias("c"),
                                    F.when(F.col("id") % 2 == 0, F.lit("even")).alias("`odd` name"))
    parts = profile.sketches(df, "day")
    assert parts.count() == 14
    merged = {r.column_name: r.n_distinct for r in profile.cardinality_of(parts).collect()}
    assert abs(merged["c"] - 3000) <= 60 and merged["`odd` name"] == 2
    one = {r.column_name: r.n_distinct for r in profile.cardinality_of(profile.sketches(df.withColumn("day", F.lit("x")), "day")).collect()}
    assert abs(one["c"] - merged["c"]) <= 30 and one["`odd` name"] == 2
