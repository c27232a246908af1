"""Registered queries over the test tables: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, each reading whole tables.  Column names match the SQL in
``larder.plans.oracle``; money is BIGINT cents throughout (see ``larder.plans.testdata``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import specs
from larder.functions.numeric import grouped_number
from larder.functions.text import display_name, quoted
from larder.functions.timecols import calendar_columns
from larder.operators import boosting, clean, forecast, profile, reports, training
from larder.operators import features as feat
from larder.operators import increment
from larder.operators.star import star_join
from larder.session import scratch_path
from larder.sources import files
from larder.streaming import standardize as streams
from larder.plans.testdata import (order_detail_table, order_table, spread,
                                   star_tables, table, task_count)

Query = Callable[[SparkSession, str], DataFrame]

# Columns whose value comes from summing doubles (not exact in any engine): rounded to 9
# decimals in both the Spark query and its SQL oracle.
ROUNDED_9 = tuple(f"dish_order_size_ratio_{h}d" for h in feat.HORIZONS)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_join(*star_tables(spark, sf_dir))


def q_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir)


def q_daily_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.daily_context(star(spark, sf_dir))


def q_daily_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.daily_item(star(spark, sf_dir))


def q_daily_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.daily_item_with_context(star(spark, sf_dir))


def q_rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.feature_store(star(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ROUNDED_9})


def q_chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = feat.daily_item(star(spark, sf_dir)).select("dish_name", "time_date", "y_sales")
    return feat.chrono_split(items)


# ---- cleaning -------------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def q_dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table twice plus a copy whose priority is lower-cased: exact copies go, rows that
    differ only in letter case stay (dedupe runs before cleaning)."""
    o = _orders(spark, sf_dir)
    variant = o.withColumn("o_orderpriority", F.lower("o_orderpriority"))
    return clean.dedupe(o.unionByName(o).unionByName(variant))


def dirty_event_type() -> F.Column:
    et = F.col("event_type")
    return (F.when(et == "error", F.lit(None).cast("string"))
            .when(et == "view", F.lit("   "))
            .when(et == "click", F.concat(F.lit("  "), F.upper(et), F.lit(" ")))
            .when(et == "purchase", F.concat(F.lit("\t"), et))
            .otherwise(F.upper(et)))


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _events(spark, sf_dir).select("event_id", dirty_event_type().alias("event_type"))
    return clean.clean_text_columns(raw, {"event_type": "unknown"})


def dirty_whole_number(value: str, key: str) -> F.Column:
    whole = F.floor(F.col(value)).cast("bigint").cast("string")
    k = F.col(key) % 8
    return (F.when(k == 0, F.lit("n/a")).when(k == 1, F.lit("")).when(k == 2, F.lit("   "))
            .when(k == 3, F.concat(F.lit(" "), whole, F.lit(" ")))
            .when(k == 4, F.concat(whole, F.lit(".5")))
            .when(k == 5, F.concat(F.lit("+"), whole))
            .when(k == 6, F.lit("1e3"))
            .otherwise(whole))


def q_clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _orders(spark, sf_dir).select(
        "o_orderkey", dirty_whole_number("o_totalprice", "o_orderkey").alias("total_price"))
    return clean.clean_numeric_columns(raw, {"total_price": 0}, ids=("o_orderkey",))


def q_clean_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    et = F.col("event_type")
    raw = e.select("event_id", F.when(et == "error", F.lit("bad"))
                   .when(et == "view", F.date_format("ts", "yyyy-MM-dd"))
                   .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"))
    return clean.parse_timestamp_columns(raw, ("ts",))


def q_strip_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean.strip_accent_columns(docs, ("text",))


def q_name_based_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    status = F.col("o_orderstatus")
    update_time = (F.when(status == "F", F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 5 HOURS"),
                                                       "yyyy-MM-dd HH:mm:ss"))
                   .when(status == "O", F.date_format("o_orderdate", "yyyy/MM/dd"))
                   .otherwise(F.lit("pending")))
    raw = o.select("o_orderkey", "o_orderstatus", "o_orderdate", update_time.alias("update_time"))
    return clean.normalize_datetime_columns(raw)


def raw_dish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a dirty item table: NULL / blank / shouted accented names, junk prices,
    every row twice."""
    p = table(spark, sf_dir, "part")
    accented = F.translate(F.upper("p_name"), "AEIOU", "ÁÊÌÕÜ")
    name = (F.when(F.col("p_size") == 1, F.lit(None).cast("string"))
            .when(F.col("p_size") == 2, F.lit("  "))
            .otherwise(F.concat(F.lit(" "), accented, F.lit(" "))))
    price = (F.when(F.col("p_size") == 3, F.lit("abc"))
             .otherwise(F.floor("p_retailprice").cast("bigint").cast("string")))
    raw = p.select(F.col("p_partkey").alias("dish_id"), name.alias("dish_name"), price.alias("price"))
    return raw.unionByName(raw)


def q_standardize_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.standardize(raw_dish(spark, sf_dir), specs.DISH)


def raw_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as text, with hours of day, unparseable times and blank prices."""
    o = order_table(spark, sf_dir).join(
        _orders(spark, sf_dir).select(F.col("o_orderkey").alias("order_id"), "o_orderstatus"), "order_id")
    when = F.col("time") + F.make_dt_interval(hours=(F.col("order_id") % 24).cast("int"))
    time_text = (F.when(F.col("o_orderstatus") == "P", F.lit("not a time"))
                 .otherwise(F.date_format(when, "yyyy-MM-dd HH:mm:ss")))
    price_text = (F.when(F.col("order_id") % 5 == 0, F.lit(""))
                  .otherwise((F.col("total_price") / 100).cast("bigint").cast("string")))
    return o.select("order_id", time_text.alias("time"), price_text.alias("total_price"),
                    F.col("quantity").cast("string").alias("quantity"))


def q_standardize_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.standardize(raw_order(spark, sf_dir), specs.ORDER)


def q_standardize_order_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose time is a timestamp already: wall-clock time is kept in any session zone."""
    o = order_table(spark, sf_dir)
    when = F.col("time") + F.make_dt_interval(hours=(F.col("order_id") % 24).cast("int"))
    return clean.standardize(o.select("order_id", when.alias("time"), "total_price", "quantity"), specs.ORDER)


def dirty_name(col: str) -> F.Column:
    return F.when(F.length(col) % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), F.translate(F.upper(col), "AEIOU", "ÁÊÌÕÜ")))


def q_standardize_dish_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as recipe lines: dirty ingredient names, units and quantities."""
    p = table(spark, sf_dir, "part")
    raw = p.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("dish_id"), F.col("p_size").cast("bigint").alias("ingredient_id"),
                   dirty_name("p_name").alias("ingredient_name"),
                   F.when(F.col("p_size") % 5 == 0, F.lit("x")).otherwise(F.col("p_size").cast("string")).alias("quantity"),
                   F.when(F.col("p_size") % 3 == 0, F.lit(None).cast("string")).otherwise(F.upper("p_type")).alias("unit"))
    return clean.standardize(raw.unionByName(raw), specs.DISH_DETAIL)


def q_standardize_ingredient(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("ingredient_id"), dirty_name("p_name").alias("ingredient_name"))
    return clean.standardize(raw.unionByName(raw), specs.INGREDIENT)


def q_standardize_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their item's dirty name, quantities and prices as text."""
    li = table(spark, sf_dir, "lineitem")
    raw = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("dish_id"),
                    dirty_name("l_linestatus").alias("dish_name"), F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
                    F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(F.floor("l_extendedprice").cast("bigint").cast("string")).alias("price"))
    return clean.standardize(raw, specs.ORDER_DETAIL)


def q_datetime_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time in eight layouts, by order key; the last is unreadable."""
    o = _orders(spark, sf_dir)
    when = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    layouts = ["yyyy-MM-dd HH:mm:ss'.5'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS", "' 'yyyy-MM-dd", "yyyy-M-d", "yyyyMMdd", "MM/dd/yyyy"]
    text = F.lit("soon")
    for i, layout in enumerate(layouts):
        text = F.when(F.col("o_orderkey") % 8 == i, F.date_format(when, layout)).otherwise(text)
    return clean.normalize_datetime_columns(o.select("o_orderkey", text.alias("update_time")))


# ---- reports ---------------------------------------------------------------------------

def _order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(F.col("o_orderkey").alias("order_id"),
                                         F.col("o_orderdate").alias("time"))


def q_orders_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_period(_order_times(spark, sf_dir), "quarter")


def q_orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_period(_order_times(spark, sf_dir), "month")


def q_revenue_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_period(order_detail_table(spark, sf_dir), _order_times(spark, sf_dir), "quarter")


def q_revenue_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_period(order_detail_table(spark, sf_dir), _order_times(spark, sf_dir), "month")


def _item_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, detail, dish = star_tables(spark, sf_dir)
    return reports.item_sales(detail, dish)


def q_item_quantity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranked(_item_sales(spark, sf_dir), "total_quantity", "dish_name")


def q_item_revenue_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranked(_item_sales(spark, sf_dir), "total_revenue", "dish_name")


def q_item_revenue_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranked(_item_sales(spark, sf_dir), "total_revenue", "dish_name", k=10)


def q_orders_by_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).select(F.col("event_id").alias("order_id"), F.col("ts").alias("time"))
    return reports.orders_by_slot(ev)


def q_distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _orders(spark, sf_dir).select(F.to_date("o_orderdate").alias("time_date"))
    return reports.distinct_sorted(days, "time_date")


def q_calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", *[v.alias(k) for k, v in calendar_columns("o_orderdate", weekday=True).items()])


# ---- forecast views over the daily item series -------------------------------------------

def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(time_date, dish_name, prediction): the daily item quantity stands in for a forecast."""
    items = feat.daily_item(star(spark, sf_dir))
    return items.select("time_date", "dish_name", F.col("y_sales").cast("double").alias("prediction"))


def q_month_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.month_mean(daily_series(spark, sf_dir))


def q_day_vs_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.day_vs_month(daily_series(spark, sf_dir))


#: The wide table's columns, listed by the caller: the test tables name 25 brands.
WIDE_COLUMNS = {f"Brand#{i}": f"Brand#{i}" for i in range(1, 26)}


def q_pivot_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.to_wide(daily_series(spark, sf_dir), WIDE_COLUMNS)


def q_unpivot_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.to_long(forecast.to_wide(daily_series(spark, sf_dir), WIDE_COLUMNS))


def q_month_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.list_months(q_partitioned_roundtrip(spark, sf_dir))


def q_month_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chosen month of the stored series (partition pruning)."""
    path = scratch_path(spark, "predictions")
    files.write_predictions(daily_series(spark, sf_dir), path)
    return files.read_predictions(spark, path, month="199503")


def q_day_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chosen day of the stored series next to its month means; only that month is read."""
    return forecast.day_vs_month(q_partitioned_roundtrip(spark, sf_dir), day="1995-03-15")


def q_item_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chosen item; its shares still compare with all items of the day."""
    return feat.daily_item_with_context(star(spark, sf_dir), items=["Brand#7"])


def q_display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names of item keys of several words."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", display_name(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("display_name"))


def q_grouped_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_orderkey", grouped_number("o_totalprice").alias("shown"))


def q_metrics_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics where every third row has no prediction: those rows count in no measure."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_returnflag").alias("dish_name"), F.col("l_quantity").cast("bigint").alias("y_sales"),
                     F.when(F.col("l_orderkey") % 3 != 0, F.col("l_linenumber") * 5.0).alias("prediction"))
    return forecast.regression_metrics(rows).withColumns({c: F.round(c, 6) for c in ("MAE", "RMSE", "R2")})


def q_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = feat.daily_item(star(spark, sf_dir)).select("dish_name", "time_date", "y_sales")
    scored = forecast.mean_baseline(feat.chrono_split(items))
    metrics = forecast.regression_metrics(scored.where(F.col("split") == "test"))
    return metrics.withColumns({c: F.round(c, 6) for c in ("MAE", "RMSE", "R2")})


# ---- profiling -------------------------------------------------------------------------

def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with NULLs injected: error types, high values and the props of views."""
    e = _events(spark, sf_dir)
    return e.select("event_id", "ts", "user_id",
                    F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
                    F.when(F.col("value") <= 90, F.col("value")).alias("value"),
                    F.when(F.col("event_type") != "view", F.col("props")).alias("props"))


def q_profile_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.basic_profile(table(spark, sf_dir, "lineitem"))


def q_profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_percentage(dirty_events(spark, sf_dir))


def q_profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.numeric_profile(table(spark, sf_dir, "lineitem"))
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.endswith(("_avg", "_std"))})


def q_profile_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cardinality(dirty_events(spark, sf_dir))


def q_profile_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    c = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return profile.correlations(c).withColumn("corr", F.round("corr", 6))


# ---- sources and sinks ------------------------------------------------------------------

def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised item table -> CSV in the shared scratch folder -> read back with its
    declared schema (no inference)."""
    path = scratch_path(spark, "dish-csv")
    files.write_table(q_standardize_dim(spark, sf_dir), path, "csv")
    return files.read_table(spark, path, "csv", schema="dish_id bigint, dish_name string, price bigint")


def q_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series -> Parquet partitioned by month, sorted by day inside -> read back."""
    path = scratch_path(spark, "predictions")
    files.write_predictions(daily_series(spark, sf_dir), path)
    return files.read_predictions(spark, path)


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dish-parquet")
    files.write_table(q_standardize_dim(spark, sf_dir), path, "parquet")
    return files.read_table(spark, path, "parquet")


def _feature_store(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "features")
    files.write_feature_store(feat.feature_store(star(spark, sf_dir)), path)
    return path


def q_feature_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item's series from the stored features: only its folder is read."""
    out = files.read_feature_store(spark, _feature_store(spark, sf_dir), item="Brand#7").drop("dish_key")
    return out.withColumns({c: F.round(c, 9) for c in ROUNDED_9})


def q_feature_store_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store grown year by year: each batch reads the order lines of its own year (the star is
    stored by year) and the rows carried over from the batch before."""
    lines, root = scratch_path(spark, "star-by-year"), scratch_path(spark, "grown-store")
    # a year's lines are written by as many tasks as their bytes ask for
    (star(spark, sf_dir).withColumn("year", F.year("time_date")).hint("rebalance", "year")
     .write.mode("overwrite").partitionBy("year").parquet(lines))
    stored = spark.read.parquet(lines)
    ends = (stored.where(F.col("year").isNotNull()).groupBy("year")
            .agg(F.max("time_date").alias("last"), F.count("*").alias("lines")).orderBy("year").collect())
    for end in ends:  # one row a year
        new = stored.where(F.col("year") == F.lit(end["year"])).drop("year")
        increment.append_days(spread(new, task_count(end["lines"]), "order_id"), root, end["last"])
    return increment.read_store(spark, root).withColumns({c: F.round(c, 9) for c in ROUNDED_9})


def q_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV and read back with the types that their texts allow."""
    path = scratch_path(spark, "orders-csv")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderpriority")
    files.write_table(o, path, "csv")
    return files.read_inferred(spark, path)


def q_dedupe_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their ids: exact copies go, by digests first."""
    return clean.dedupe_wide(table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars"))


def q_cardinality_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of orders stored by order year and merged, against the exact counts."""
    path = scratch_path(spark, "sketches")
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string").alias("customer"))
    profile.sketches(o, "year").write.mode("overwrite").partitionBy("part").parquet(path)
    guess = profile.cardinality_of(spark.read.parquet(path)).withColumnRenamed("n_distinct", "guess")
    both = profile.cardinality(o).join(guess, "column_name")
    return both.select("column_name", "n_distinct", (F.abs(F.col("guess") - F.col("n_distinct")) * 20 <= F.col("n_distinct")).alias("within_5_percent"))


# ---- streaming ---------------------------------------------------------------------------

def q_stream_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean_text`` as a stream: the events file is read as a file stream, cleaned
    micro-batch by micro-batch into Parquet (exactly once, checkpointed), and read back."""
    schema = table(spark, sf_dir, "events").schema
    stream = streams.read_stream(spark, sf_dir, schema, "parquet", file_glob="events.parquet")
    raw = stream.select("event_id", dirty_event_type().alias("event_type"))
    cleaned = clean.clean_text_columns(raw, {"event_type": "unknown"})
    out = scratch_path(spark, "stream-events")
    return streams.run_available(cleaned, out, name="clean_text_" + out.rsplit("-", 1)[-1],
                                 checkpoint_location=scratch_path(spark, "stream-checkpoint"))


# ---- model training and batch prediction ---------------------------------------------------

def _stored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written to the store, read back with calendar inputs and split by time."""
    stored = training.with_model_calendar(files.read_feature_store(spark, _feature_store(spark, sf_dir)))
    path = scratch_path(spark, "split")
    files.write_table(feat.chrono_split(stored), path, "parquet")  # a fit reads it once per round
    return files.read_table(spark, path, "parquet")


def q_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many inputs a model gets, and how many rows and what target total each split holds."""
    split = _stored_split(spark, sf_dir)
    inputs = training.feature_columns(split)
    return split.groupBy("split").agg(F.lit(len(inputs)).cast("bigint").alias("inputs"), F.count(F.lit(1)).alias("rows"),
                                      F.sum("y_sales").alias("target"))


def q_forecast_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature store -> chronological split -> one boosted model over all items with the documented
    settings and early stopping -> saved, loaded -> a prediction for every item-day."""
    split = _stored_split(spark, sf_dir)
    root = scratch_path(spark, "pooled-model")
    training.fit_pooled(split).save(root)
    return training.predict_pooled(split, training.PooledModel.load(spark, root))


def q_forecast_predict_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and scored rows of each item in the monthly prediction store."""
    path = scratch_path(spark, "forecast")
    files.write_predictions(q_forecast_predict(spark, sf_dir), path)
    return files.read_predictions(spark, path).groupBy("dish_name").agg(
        F.count(F.lit(1)).alias("rows"), F.min("time_date").alias("first_day"), F.max("time_date").alias("last_day"),
        F.count("prediction").alias("scored"))


#: One tree of one split an item, fitted to all train rows: what SQL can state.
ONE_SPLIT = training.BoostParams(n_estimators=1, max_depth=1, learning_rate=1.0, subsample=1.0, colsample_bytree=1.0, stopping="none")


def _saved_models(spark: SparkSession, split: DataFrame, default: training.BoostParams) -> tuple[str, boosting.ItemModels]:
    """Models of every item of ``split``: fitted, saved, found in the store and loaded."""
    root = scratch_path(spark, "item-models")
    boosting.fit_items(split, default=default).save(root)
    return root, boosting.ItemModels.load(spark, root)


def q_boost_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first split that boosting finds for every item, and its two leaves."""
    trees = _saved_models(spark, _stored_split(spark, sf_dir), ONE_SPLIT)[1].trees.where("tree = 0")
    leaf = lambda node, c: F.round(F.max(F.when(F.col("node") == node, F.col(c))), 6)
    return trees.groupBy("dish_name").agg(
        F.max(F.when(F.col("node") == 0, F.col("feature"))).alias("feature"), leaf(0, "cut").alias("cut"), leaf(1, "value").alias("left_value"),
        leaf(2, "value").alias("right_value"), leaf(1, "rows").alias("left_rows"), leaf(2, "rows").alias("right_rows"))


def q_forecast_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-split models of every item: fitted, saved, loaded, all items scored in one plan on the
    test split, and rated."""
    split = _stored_split(spark, sf_dir)
    test = split.where(F.col("split") == "test")
    scored = boosting.score_items(test, _saved_models(spark, split, ONE_SPLIT)[1].kept(), keep=("time_date", "y_sales"))
    return forecast.regression_metrics(scored).withColumns({c: F.round(c, 6) for c in ("MAE", "RMSE", "R2")})


def q_item_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of every item with the documented settings (800 rounds, depth 7, rate 0.03, 0.9 of rows and
    columns, seed 42, patience 50): which items the store lists, whether rounds ended and trees were
    cut as the patience rule says, worked out anew from the errors, and how many rows were scored."""
    split = _stored_split(spark, sf_dir)
    root, models_ = _saved_models(spark, split, training.BoostParams())
    rule = boosting.patience_rule(models_.rounds, training.BoostParams())
    kept = models_.kept()
    trees = kept.where("tree >= 0").groupBy("dish_name").agg(F.count_distinct("tree").alias("trees"))
    scored = boosting.score_items(split, kept).groupBy("dish_name").agg(F.count("prediction").alias("scored"))
    base = split.groupBy("dish_name").agg(*[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "valid", "test")])
    listed = boosting.listed_items(spark, root).withColumn("listed", F.lit(True))
    out = base.join(listed, "dish_name", "left").join(rule, "dish_name", "left").join(trees, "dish_name", "left").join(scored, "dish_name", "left")
    return out.select("dish_name", "train_rows", "valid_rows", "test_rows", "listed", (F.col("ran") == F.col("due")).alias("stopped_as_due"),
                      (F.col("trees") == F.col("best") + 1).alias("cut_at_best"), "scored")


#: Rounds of the models behind the monthly files.
MONTHLY = training.BoostParams(n_estimators=40, learning_rate=0.1, max_depth=4)


def q_forecast_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of every listed model, one column an item and one row a day, written by month; then
    the last month is predicted again and replaces its own files only.  Days and cells of every month, and
    whether its files are those of the first write."""
    split = _stored_split(spark, sf_dir)
    root, models_ = _saved_models(spark, split, MONTHLY)
    items = [r["dish_name"] for r in boosting.listed_items(spark, root).orderBy("dish_name").collect()]  # the columns
    path = scratch_path(spark, "monthly")
    files.write_predictions(forecast.to_wide(boosting.score_items(split, models_.kept()), {i: i for i in items}), path)
    shown = lambda: files.read_predictions(spark, path).withColumn("file", F.input_file_name())
    before = scratch_path(spark, "monthly-files")
    files.write_table(shown().select("month", "file").distinct(), before, "parquet")
    last = split.agg(F.max("time_date")).head()[0]
    of_month = split.where(F.col("time_date") >= F.trunc(F.lit(last), "month")) if last is not None else split
    files.write_predictions(forecast.to_wide(boosting.score_items(of_month, models_.kept()), {i: i for i in items}), path, only_months=True)
    cells = sum((F.col(quoted(i)).isNotNull().cast("bigint") for i in items), F.lit(0).cast("bigint"))
    old = files.read_table(spark, before, "parquet").withColumn("same", F.lit(1))
    now = shown().select("month", "time_date", "file", cells.alias("cells")).join(old, ["month", "file"], "left")
    return now.groupBy("month").agg(F.count_distinct("time_date").alias("days"), F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("rows"),
                                    (F.count("same") == F.count(F.lit(1))).alias("untouched"))


def q_feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input vector of every item-day, as its length and weighted sums of its whole-number and other values."""
    split = _stored_split(spark, sf_dir)
    inputs = training.feature_columns(split)
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep")
    values = assembler.transform(split).withColumn("_values", vector_to_array("_features"))
    whole = {f.name for f in split.schema.fields if f.dataType.typeName() in ("integer", "long")}

    def weighted(of_whole: bool):
        weights = F.array(*[F.lit(float(i) if (c in whole) == of_whole else 0.0) for i, c in enumerate(inputs, 1)])
        return F.aggregate(F.zip_with("_values", weights, lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v)

    return values.select("dish_name", "time_date", "split", "y_sales", F.size("_values").cast("bigint").alias("inputs"),
                         weighted(True).cast("bigint").alias("whole"), F.round(weighted(False) + 0.0137, 1).alias("ratios"))


def q_day_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as forecasts with a time of day: the first of each item and day beside the month's mean."""
    lines = star(spark, sf_dir).where(F.col("dish_name").isNotNull())
    timed = lines.select("dish_name", F.expr("cast(time_date as timestamp_ntz) + make_dt_interval(0, cast(order_id % 24 as int))").alias("time_date"), F.col("dish_quantity").cast("double").alias("prediction"))
    return forecast.day_vs_month(timed, first_only=True).withColumn("month_mean", F.round("month_mean", 9))


def q_profile_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric profile of the order lines from states stored by return flag and merged afterwards."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")))
    path = scratch_path(spark, "profile-states")
    files.write_table(profile.merge_moments(profile.moments(lines, by="l_returnflag"), by_part=True), path, "parquet")
    whole = profile.numeric_profile_of(profile.merge_moments(files.read_table(spark, path, "parquet")))
    return whole.select("column_name", F.round("minimum", 6).alias("minimum"), F.round("maximum", 6).alias("maximum"), F.round(F.col("avg") + 0.0000137, 4).alias("avg"),
                        F.round(F.col("std") + 0.0000137, 4).alias("std"), "missing")  # an offset, so that no mean of prices ends in a five


def q_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed item table cleaned onto its own path: staged beside it, then renamed into its place."""
    path = scratch_path(spark, "replaced")
    p = table(spark, sf_dir, "part")
    files.replace_table(p.select("p_partkey", F.concat(F.lit("  "), F.upper("p_name")).alias("p_name"), "p_size").unionByName(p.select("p_partkey", "p_name", "p_size")), path)
    files.replace_table(clean.clean_text_columns(files.read_table(spark, path, "parquet"), {"p_name": "unknown"}).distinct(), path)
    return files.read_table(spark, path, "parquet")


QUERIES: dict[str, Query] = {
    "star_join": q_star_join,
    "daily_context": q_daily_context,
    "daily_item": q_daily_item,
    "daily_share": q_daily_share,
    "rolling_features": q_rolling_features,
    "chrono_split": q_chrono_split,
    "dedupe_rows": q_dedupe_rows,
    "clean_text": q_clean_text,
    "clean_numeric": q_clean_numeric,
    "clean_timestamp": q_clean_timestamp,
    "strip_accents": q_strip_accents,
    "name_based_datetime": q_name_based_datetime,
    "standardize_dim": q_standardize_dim,
    "standardize_order": q_standardize_order,
    "orders_by_quarter": q_orders_by_quarter,
    "orders_by_month": q_orders_by_month,
    "revenue_by_quarter": q_revenue_by_quarter,
    "revenue_by_month": q_revenue_by_month,
    "item_quantity_rank": q_item_quantity_rank,
    "item_revenue_top10": q_item_revenue_top10,
    "orders_by_slot": q_orders_by_slot,
    "distinct_days": q_distinct_days,
    "calendar_features": q_calendar_features,
    "month_mean": q_month_mean,
    "day_vs_month": q_day_vs_month,
    "pivot_by_day": q_pivot_by_day,
    "unpivot_by_day": q_unpivot_by_day,
    "forecast_metrics": q_forecast_metrics,
    "profile_basic": q_profile_basic,
    "profile_missing": q_profile_missing,
    "profile_numeric": q_profile_numeric,
    "profile_cardinality": q_profile_cardinality,
    "profile_correlation": q_profile_correlation,
    "csv_roundtrip": q_csv_roundtrip,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "stream_clean_text": q_stream_clean_text,
    "parquet_roundtrip": q_parquet_roundtrip,
    "feature_store_roundtrip": q_feature_store_roundtrip,
    "feature_store_by_days": q_feature_store_by_days,
    "csv_inferred": q_csv_inferred,
    "dedupe_wide": q_dedupe_wide,
    "cardinality_by_sketch": q_cardinality_by_sketch,
    "month_list": q_month_list,
    "month_read": q_month_read,
    "day_view": q_day_view,
    "item_filter": q_item_filter,
    "item_revenue_rank": q_item_revenue_rank,
    "display_name": q_display_name,
    "grouped_number": q_grouped_number,
    "metrics_with_gaps": q_metrics_with_gaps,
    "standardize_order_typed": q_standardize_order_typed,
    "standardize_dish_detail": q_standardize_dish_detail,
    "standardize_ingredient": q_standardize_ingredient,
    "standardize_order_detail": q_standardize_order_detail,
    "datetime_layouts": q_datetime_layouts,
    "feature_matrix": q_feature_matrix,
    "forecast_predict": q_forecast_predict,
    "forecast_predict_coverage": q_forecast_predict_coverage,
    "forecast_model_metrics": q_forecast_model_metrics,
    "boost_first_split": q_boost_first_split,
    "item_models": q_item_models,
    "forecast_by_month": q_forecast_by_month,
    "feature_vectors": q_feature_vectors,
    "day_first_row": q_day_first_row,
    "profile_by_state": q_profile_by_state,
    "replace_table": q_replace_table,
}
