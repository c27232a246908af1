import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.operators import forecast

D = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]


def long_df(spark):
    rows = [(d, item, float(i + j)) for i, d in enumerate(D) for j, item in enumerate(["pho bo", "bun cha"])]
    return spark.createDataFrame(rows, "time_date date, dish_name string, prediction double")


def test_wide_and_back(spark):
    wide = forecast.to_wide(long_df(spark), {"bun cha": "bun_cha", "pho bo": "pho_bo"})
    assert wide.columns == ["time_date", "bun_cha", "pho_bo", "month"]
    back = forecast.to_long(wide)
    assert sorted(back.columns) == ["dish_name", "month", "prediction", "time_date"]
    assert back.where(F.col("dish_name") == "month").count() == 0
    assert back.count() == 6


def test_month_views(spark):
    means = {(r.month, r.dish_name): r.month_mean for r in forecast.month_mean(long_df(spark)).collect()}
    assert means[("202401", "pho bo")] == 0.5 and means[("202402", "bun cha")] == 3.0
    day = forecast.day_vs_month(long_df(spark), day="2024-01-31").collect()
    assert {(r.display_name, r.prediction, r.month_mean) for r in day} == {("Pho Bo", 1.0, 0.5), ("Bun Cha", 2.0, 1.5)}


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 3.0), ("b", 5, 1.0), ("b", 5, 2.0)],
                               "dish_name string, y_sales long, prediction double")
    got = {r.dish_name: r for r in forecast.regression_metrics(df).collect()}
    assert got["a"].MAE == 0.5 and got["a"].RMSE == pytest.approx(0.5 ** 0.5)
    assert got["a"].R2 == pytest.approx(1 - 1 / 2)
    assert got["b"].R2 is None  # constant label


def test_metrics_skip_rows_without_prediction(spark):
    rows = [("a", 1, 1.0), ("a", 3, 2.0), ("a", 1000, None)]
    got = forecast.regression_metrics(spark.createDataFrame(rows, "dish_name string, y_sales long, prediction double")).head()
    assert got.MAE == 0.5 and got.R2 == pytest.approx(1 - 1 / 2)


def test_wide_refuses_names_that_meet_and_keeps_odd_ones(spark):
    day = D[0]
    rows = spark.createDataFrame([(day, "a b", 1.0), (day, "a_b", 2.0), (day, "st. louis", 3.0), (day, "month", 4.0)],
                                 "time_date date, dish_name string, prediction double")
    with pytest.raises(ValueError):
        forecast.to_wide(rows, {"a b": "a_b", "a_b": "a_b"})
    with pytest.raises(ValueError):
        forecast.to_wide(rows, {"month": "month"})
    wide = forecast.to_wide(rows, {"a b": "a b", "a_b": "a_b", "st. louis": "st. louis", "month": "month (item)"})
    back = {(r.dish_name, r.prediction) for r in forecast.to_long(wide).collect()}
    assert back == {("a b", 1.0), ("a_b", 2.0), ("st. louis", 3.0), ("month (item)", 4.0)}
    twice = rows.unionByName(rows)
    with pytest.raises(Exception, match="two values"):
        forecast.to_wide(twice, {"a b": "x"}).collect()


def test_one_day_reads_one_month_of_the_store(spark, tmp_path):
    from larder.sources import files

    files.write_predictions(long_df(spark), str(tmp_path / "p"))
    view = forecast.day_vs_month(files.read_predictions(spark, str(tmp_path / "p")), day="2024-01-31")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "202401" in plan
    assert view.count() == 2
