"""Plan-shape checks for the flagship at scale settings (broadcast off, as for large tables)."""

import re

import pytest

from larder.plans.catalog import q_rolling_features

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark, no_broadcast):
    df = q_rolling_features(spark, SF)
    df.count()
    text = plan_text(df)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "SinglePartition" not in text
    windows = [ln for ln in text.split("\n") if ln.strip().startswith("+- Window [") or ln.startswith("Window [")]
    assert len(windows) == 2, windows  # day-context window + one window for every horizon
    assert any("windowspecdefinition(time_date" in w for w in windows)
    assert any("windowspecdefinition(dish_name" in w for w in windows)
    # the star (order lines joined to orders and items) is built and aggregated once
    assert text.count("Expand [") == 1
    assert len(re.findall(r"SortMergeJoin \[dish_id", text)) == 1


def test_lineitem_scan_is_pruned(spark):
    df = q_rolling_features(spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", text):
        assert "l_comment" not in schema and "l_shipdate" not in schema


def test_item_training_reads_one_partition(spark, tmp_path):
    from pyspark.sql import functions as F

    from larder.operators import features as feat
    from larder.operators import training
    from larder.operators.star import star_join
    from larder.plans.testdata import star_tables
    from larder.sources import files

    path = str(tmp_path / "fs")
    files.write_feature_store(feat.feature_store(star_join(*star_tables(spark, SF))), path)
    split = feat.chrono_split(training.with_model_calendar(files.read_feature_store(spark, path)), item_col="dish_key")
    text = plan_text(split.where(F.col("dish_key") == "Brand#3"))
    assert re.search(r"PartitionFilters: \[[^\]]*dish_key#\d+ = Brand#3", text), text


def test_revenue_report_joins_at_order_grain(spark, no_broadcast):
    from larder.plans.catalog import q_revenue_by_quarter

    df = q_revenue_by_quarter(spark, SF)
    df.count()
    text = plan_text(df)
    join = text.index("SortMergeJoin")
    below = text[join:]
    # the line side of the join is already summed per order (partial + final aggregate)
    assert re.search(r"HashAggregate\(keys=\[order_id#\d+L\], functions=\[sum", below), below
