"""Large tables: a task's share of the star, and aggregation before windows."""

import datetime as dt

import pytest

from larder.operators import forecast
from larder.plans import catalog, testdata

SHUFFLED = "Exchange hashpartitioning"


@pytest.fixture
def small_tables(spark, tmp_path):
    orders = [(i, 100.0 + i, dt.datetime(2020 + i % 3, 1 + i % 12, 1 + i % 28)) for i in range(60)]
    spark.createDataFrame(orders + [(None, 1.0, None)], "o_orderkey long, o_totalprice double, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i % 60, i % 7, float(1 + i % 5), 10.0 + i) for i in range(300)] + [(None, 1, 2.0, 3.0), (5, None, 2.0, 3.0)]
    (spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    spark.createDataFrame([(i, f"Brand#{i % 3}", 9.0 + i) for i in range(6)], "p_partkey long, p_brand string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_of_the_star_grow_with_the_lines(spark, small_tables, monkeypatch):
    """the number of tasks follows the lines, rows stay the same."""
    before = rows(catalog.q_daily_item(spark, small_tables))
    monkeypatch.setattr(testdata, "WHOLE_LINES", 50)
    monkeypatch.setattr(testdata, "TASK_LINES", 20)
    order, detail, _ = testdata.star_tables(spark, small_tables)
    assert detail.rdd.getNumPartitions() == 16  # 302 lines
    assert "order_id#" in order._jdf.queryExecution().toString() and ", 16)" in order._jdf.queryExecution().toString()
    assert rows(catalog.q_daily_item(spark, small_tables)) == before


def test_first_rows_are_aggregated_before_any_window(spark):
    """no window holds the raw rows of an item-month; ties, nulls and months stay as they were."""
    t = lambda d, h: dt.datetime(2020, 1, d, h)
    data = [(t(1, 5), "a_b", 4.0), (t(1, 5), "a_b", 2.0), (t(1, 9), "a_b", 1.0), (t(2, 0), "a_b", None), (t(2, 0), "a_b", 5.0),
            (None, "a_b", 3.0), (None, "a_b", 7.0), (t(1, 1), None, 8.0), (dt.datetime(2020, 2, 1), "a_b", 6.0)]
    df = spark.createDataFrame(data, "time_date timestamp, dish_name string, prediction double")
    out = forecast.day_vs_month(df, first_only=True)
    found = {(r.dish_name, r.time_date): (r.month, r.display_name, r.prediction, r.month_mean) for r in out.collect()}
    assert found == {
        ("a_b", t(1, 5)): ("202001", "A B", 2.0, 3.0), ("a_b", t(2, 0)): ("202001", "A B", None, 3.0), ("a_b", None): (None, "A B", 3.0, 5.0),
        (None, t(1, 1)): ("202001", None, 8.0, 8.0), ("a_b", dt.datetime(2020, 2, 1)): ("202002", "A B", 6.0, 6.0)}
    one = forecast.day_vs_month(df, day="2020-01-02", first_only=True).collect()
    assert [(r.prediction, r.month_mean) for r in one] == [(None, 3.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate") and "Window" not in plan[plan.rindex("Aggregate"):]


def test_a_year_is_written_by_as_many_tasks_as_it_needs(spark, small_tables, monkeypatch):
    """no year goes to one task whatever its size; the store's rows are those of the whole plan."""
    whole = rows(catalog.q_rolling_features(spark, small_tables))
    monkeypatch.setattr(testdata, "WHOLE_LINES", 50)
    monkeypatch.setattr(testdata, "TASK_LINES", 20)
    kept = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: kept.append(f"{small_tables}/{name}") or kept[-1])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1000")
    try:
        found = rows(catalog.q_feature_store_by_days(spark, small_tables))
    finally:
        spark.conf.unset(size)
    assert found == whole
    import glob

    assert max(len(glob.glob(f"{y}/*.parquet")) for y in glob.glob(f"{kept[0]}/year=20*")) > 1
