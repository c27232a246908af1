import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.sources import files


def test_unsupported_format(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: json"):
        files.read_table(spark, str(tmp_path), "json")
    with pytest.raises(ValueError):
        files.write_table(spark.range(1), str(tmp_path / "x"), "json")


def test_csv_round_trip_with_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "pho bo", 30), (2, "", 0), (3, None, 1)],
                               "dish_id long, dish_name string, price long")
    ddl = "dish_id long, dish_name string, price long"
    files.write_table(df, str(tmp_path / "dish"), "csv", single_file=True)
    back = files.read_table(spark, str(tmp_path / "dish"), "csv", schema=ddl)
    assert sorted(map(tuple, back.collect())) == [(1, "pho bo", 30), (2, None, 0), (3, None, 1)]
    files.write_table(df, str(tmp_path / "exact"), "csv", null_value="\\N")
    exact = files.read_table(spark, str(tmp_path / "exact"), "csv", schema=ddl, null_value="\\N")
    assert sorted(map(tuple, exact.collect())) == [(1, "pho bo", 30), (2, "", 0), (3, None, 1)]
    inferred = files.read_table(spark, str(tmp_path / "dish"), "csv")
    assert dict(inferred.dtypes)["dish_id"] == "int"


def test_feature_store_partitions(spark, tmp_path):
    df = spark.createDataFrame([("pho bo", dt.date(2024, 1, 1), 3), ("bun cha", dt.date(2024, 1, 1), 4)],
                               "dish_name string, time_date date, y_sales long")
    path = str(tmp_path / "fs")
    files.write_feature_store(df, path)
    one = files.read_feature_store(spark, path, item="pho bo")
    assert [(r.dish_name, r.y_sales, r.dish_key) for r in one.collect()] == [("pho bo", 3, "item-pho bo")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "dish_key" in plan
    files.write_table(df.drop("time_date"), str(tmp_path / "bad"), "parquet")
    with pytest.raises(ValueError):
        files.read_feature_store(spark, str(tmp_path / "bad"))


def test_predictions_by_month(spark, tmp_path):
    rows = [(dt.date(2024, 1, 31), "a", 1.0), (dt.date(2024, 2, 1), "a", 2.0), (dt.date(2024, 1, 30), "a", 0.5)]
    df = spark.createDataFrame(rows, "time_date date, dish_name string, prediction double")
    path = str(tmp_path / "pred")
    files.write_predictions(df, path)
    back = files.read_predictions(spark, path)
    assert [r.month for r in files.list_months(back).collect()] == ["202401", "202402"]
    assert files.read_predictions(spark, path, month="202401").count() == 2
    missing = files.read_predictions(spark, str(tmp_path / "none"), schema="time_date date, month string")
    assert missing.count() == 0
    assert F is not None


def test_items_with_like_names_stay_apart(spark, tmp_path):
    names = ["a b", "a_b", "a/b", "001", "1", "2024-01-01", "", "é=%"]
    df = spark.createDataFrame([(n, dt.date(2024, 1, 1), i) for i, n in enumerate(names)], "dish_name string, time_date date, y_sales long")
    files.write_feature_store(df, str(tmp_path / "fs"))
    for i, n in enumerate(names):
        assert [(r.dish_name, r.y_sales) for r in files.read_feature_store(spark, str(tmp_path / "fs"), item=n).collect()] == [(n, i)]


def test_only_a_missing_store_reads_as_empty(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        files.read_predictions(spark, str(tmp_path / "broken"), schema="time_date date, month string").collect()


def test_appended_files_are_seen(spark, tmp_path):
    from larder.plans.testdata import table

    spark.range(5).write.parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").count() == 5
    spark.range(7).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").count() == 12


def test_scratch_folder_is_required_on_a_cluster():
    from larder.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_replacement_onto_its_own_path_and_failures(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    files.replace_table(spark.range(5).withColumn("v", F.col("id") * 2), path)
    files.replace_table(files.read_table(spark, path, "parquet").where("id > 1"), path)
    assert sorted(r.id for r in files.read_table(spark, path, "parquet").collect()) == [2, 3, 4]
    broken = files.read_table(spark, path, "parquet").withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        files.replace_table(broken, path)
    assert sorted(r.id for r in files.read_table(spark, path, "parquet").collect()) == [2, 3, 4]
    assert os.listdir(tmp_path) == ["t"]
    # a driver lost between the two renames: the old table comes back, nothing else is left
    files._rename(spark, path, path + ".old")
    files.recover_table(spark, path)
    assert sorted(r.id for r in files.read_table(spark, path, "parquet").collect()) == [2, 3, 4] and os.listdir(tmp_path) == ["t"]


def test_months_are_replaced_alone(spark, tmp_path):
    import os

    path = str(tmp_path / "p")
    rows = [(dt.date(2024, m, d), "a", float(m * 100 + d)) for m in (1, 2, 3) for d in (1, 2)]
    df = spark.createDataFrame(rows, "time_date date, dish_name string, prediction double")
    files.write_predictions(df, path)
    names = {m: sorted(os.listdir(f"{path}/month=20240{m}")) for m in (1, 2, 3)}
    files.write_predictions(df.where("month(time_date) = 2").withColumn("prediction", F.lit(0.0)), path, only_months=True)
    assert all((sorted(os.listdir(f"{path}/month=20240{m}")) == names[m]) == (m != 2) for m in (1, 2, 3))
    assert sorted(r.prediction for r in files.read_predictions(spark, path).collect()) == [0.0, 0.0, 101.0, 102.0, 301.0, 302.0]
