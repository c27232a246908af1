"""Daily feature store: day context, item-day aggregates, share ratios and strict rolling
windows for every item in one plan.

Plan shape of ``feature_store`` (checked by ``tests/test_plans.py``): the order-line star is
read and shuffled **once**: a single grouping-sets aggregation computes the day level and
the item-day level together (partial aggregation before the shuffle), a window partitioned
by day copies the day context onto each item-day row, and all rolling columns of all
horizons come from one window partitioned by item and ordered by day.  Both windows run on
aggregated rows (at most one per item and day), so an item or a day holding a third of all
order lines still puts only one row per day (or per item) into a window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.numeric import safe_ratio, strict_ratio
from larder.session import cached

# Rolling horizons in rows, and the chronological split fractions.
HORIZONS = (3, 7, 14, 30)
TRAIN_FRACTION, VALID_FRACTION = 0.6, 0.2

# Names of the one-day columns.
CONTEXT_1D = ("day_order_count_1d", "day_total_quantity_1d", "day_total_revenue_1d",
              "day_order_variety_1d", "avg_order_size_1d")
ITEM_1D = ("y_sales", "dish_count_in_order_1d", "dish_quantity_in_order_avg_1d",
           "dish_base_price", "dish_revenue_day_1d", "dish_total_quantity_1d")
SHARE_1D = ("dish_sales_ratio_daily_1d", "dish_order_ratio_daily_1d",
            "dish_revenue_ratio_daily_1d", "dish_order_size_ratio_1d")


def daily_context(star: DataFrame, date_col: str = "time_date") -> DataFrame:
    """One row per day over all items.  Order-level values are summed over the joined
    *lines*, so an order with k lines counts k times (kept on purpose).

    The two distinct counts come from one grouping-sets aggregation, sets ``(day, order)``
    and ``(day, dish_id)``, followed by a count per day: two rows per line go into partial
    aggregation, where the COUNT DISTINCT rewrite would make three."""
    keyed = star.groupingSets([[date_col, "order_id"], [date_col, "dish_id"]], date_col, "order_id", "dish_id")
    fine = keyed.agg(F.grouping_id().alias("_set"),
                     F.sum("order_quantity").alias("_qty"), F.sum("order_total_price").alias("_rev"))
    per_order = F.col("_set") == F.lit(1)  # (day, order) rows; (day, dish_id) rows have _set 2
    n_orders = F.count(F.when(per_order, F.col("order_id")))
    total_qty = F.sum(F.when(per_order, F.col("_qty")))
    return fine.groupBy(date_col).agg(
        n_orders.alias("day_order_count_1d"),
        total_qty.alias("day_total_quantity_1d"),
        F.sum(F.when(per_order, F.col("_rev"))).alias("day_total_revenue_1d"),
        F.count(F.when(~per_order, F.col("dish_id"))).alias("day_order_variety_1d"),
        safe_ratio(total_qty, n_orders).alias("avg_order_size_1d"),
    )


def daily_item(star: DataFrame, item_col: str = "dish_name", date_col: str = "time_date",
               items: list[str] | None = None) -> DataFrame:
    """One row per item and day.  Lines of unknown items (NULL name) are left out here but
    still count in ``daily_context``.  ``dish_base_price`` is the lowest unit price seen that
    day (deterministic where a first-seen value would not be)."""
    lines = star.where(F.col(item_col).isNotNull())
    if items is not None:
        lines = lines.where(F.col(item_col).isin(list(items)))
    qty = F.sum("dish_quantity")
    n_orders = F.count_distinct("order_id")
    return lines.groupBy(item_col, date_col).agg(
        qty.alias("y_sales"),
        n_orders.alias("dish_count_in_order_1d"),
        safe_ratio(qty, n_orders).alias("dish_quantity_in_order_avg_1d"),
        F.min("price_one_dish").alias("dish_base_price"),
        F.sum("price_total_dish").alias("dish_revenue_day_1d"),
        qty.alias("dish_total_quantity_1d"),
    )


def daily_share(item_day: DataFrame, context: DataFrame, date_col: str = "time_date") -> DataFrame:
    """Attach the day context to each item-day row and add the four share-of-day ratios
    (NULL when the day total is 0).  ``context`` has one row per day; AQE broadcasts it
    once it has measured it."""
    joined = item_day.join(context, on=date_col, how="left")
    return joined.withColumns({
        "dish_sales_ratio_daily_1d": safe_ratio(F.col("dish_total_quantity_1d"), F.col("day_total_quantity_1d")),
        "dish_order_ratio_daily_1d": safe_ratio(F.col("dish_count_in_order_1d"), F.col("day_order_count_1d")),
        "dish_revenue_ratio_daily_1d": safe_ratio(F.col("dish_revenue_day_1d"), F.col("day_total_revenue_1d")),
        "dish_order_size_ratio_1d": F.try_divide(F.col("dish_quantity_in_order_avg_1d"), F.col("avg_order_size_1d")),
    })


_SET_ITEM, _SET_VARIETY, _SET_ORDERS = 1, 10, 9  # grouping_id of (item, day, order_id, dish_id)


def daily_item_with_context(star: DataFrame, item_col: str = "dish_name", date_col: str = "time_date",
                            items: list[str] | None = None) -> DataFrame:
    """Same rows and columns as ``daily_share(daily_item(star), daily_context(star))``, with
    the star aggregated in a single pass.

    One grouping-sets aggregation over the star with the sets ``(item, day, order)``,
    ``(day, dish_id)`` and ``(day, order)``, then a count per ``(item, day)`` and per day,
    gives every distinct count (orders per item-day, items per day, orders per day) and the
    order-level day totals: three rows per line go into partial aggregation, where a
    COUNT DISTINCT rewrite of the two separate aggregations would need six, plus a second
    scan and shuffle of the order lines.  The day rows are then copied onto that day's item
    rows by a window partitioned by day (at most one row per item in a partition).
    """
    keyed = star.groupingSets([[item_col, date_col, "order_id"], [date_col, "dish_id"],
                               [date_col, "order_id"]],
                              item_col, date_col, "order_id", "dish_id")
    fine = keyed.agg(
        F.grouping_id().alias("_set"),
        F.sum("dish_quantity").alias("_qty"),
        F.sum("price_total_dish").alias("_rev"),
        F.min("price_one_dish").alias("_price"),
        F.sum("order_quantity").alias("_order_qty"),
        F.sum("order_total_price").alias("_order_rev"),
    )
    per_item = F.col("_set") == F.lit(_SET_ITEM)
    # A single consumer of the aggregation (otherwise Spark would aggregate the star twice):
    # item rows, per-day variety rows and per-day order rows travel together.
    rows = (fine.withColumn(item_col, F.when(per_item, F.col(item_col)))
            .groupBy("_set", item_col, date_col).agg(
                F.count("order_id").alias("_orders"),
                F.count("dish_id").alias("day_order_variety_1d"),
                F.sum("_qty").alias("y_sales"),
                F.sum("_rev").alias("dish_revenue_day_1d"),
                F.min("_price").alias("dish_base_price"),
                F.sum("_order_qty").alias("day_total_quantity_1d"),
                F.sum("_order_rev").alias("day_total_revenue_1d"))
            .withColumn("_kind", F.when(per_item, F.lit("item"))
                        .when(F.col("_set") == F.lit(_SET_VARIETY), F.lit("variety"))
                        .otherwise(F.lit("orders")))
            .withColumn("dish_count_in_order_1d", F.col("_orders"))
            .withColumn("day_order_count_1d", F.col("_orders"))
            .drop("_set", "_orders"))
    day = Window.partitionBy(date_col)

    def day_value(kind: str, c: str) -> Column:
        return F.max(F.when(F.col("_kind") == F.lit(kind), F.col(c))).over(day)

    ctx = {
        "day_order_count_1d": day_value("orders", "day_order_count_1d"),
        "day_total_quantity_1d": day_value("orders", "day_total_quantity_1d"),
        "day_total_revenue_1d": day_value("orders", "day_total_revenue_1d"),
        "day_order_variety_1d": day_value("variety", "day_order_variety_1d"),
    }
    ctx["avg_order_size_1d"] = safe_ratio(ctx["day_total_quantity_1d"], ctx["day_order_count_1d"])
    joined = rows.select(
        F.col("_kind"), F.col(item_col), F.col(date_col),
        F.col("y_sales"),
        F.col("dish_count_in_order_1d"),
        safe_ratio(F.col("y_sales"), F.col("dish_count_in_order_1d")).alias("dish_quantity_in_order_avg_1d"),
        F.col("dish_base_price"),
        F.col("dish_revenue_day_1d"),
        F.col("y_sales").alias("dish_total_quantity_1d"),
        *[v.alias(k) for k, v in ctx.items()],
    )
    keep = (F.col("_kind") == F.lit("item")) & F.col(item_col).isNotNull()
    if items is not None:
        keep = keep & F.col(item_col).isin(list(items))
    joined = joined.where(keep).drop("_kind")
    return joined.withColumns({
        "dish_sales_ratio_daily_1d": safe_ratio(F.col("dish_total_quantity_1d"), F.col("day_total_quantity_1d")),
        "dish_order_ratio_daily_1d": safe_ratio(F.col("dish_count_in_order_1d"), F.col("day_order_count_1d")),
        "dish_revenue_ratio_daily_1d": safe_ratio(F.col("dish_revenue_day_1d"), F.col("day_total_revenue_1d")),
        "dish_order_size_ratio_1d": F.try_divide(F.col("dish_quantity_in_order_avg_1d"), F.col("avg_order_size_1d")),
    })


def rolling_columns(h: int, item_col: str = "dish_name", date_col: str = "time_date",
                    lag_days: int = 0) -> list[Column]:
    """The eleven strict rolling columns of horizon ``h``.

    The frame is the last ``h`` *rows* of the item ending at the current row (days without
    sales are absent and are not filled).  A value is given only when the frame holds exactly
    ``h`` rows; otherwise sums are 0 and ratios 0.0.  ``lag_days=k`` ends the frame ``k``
    rows earlier, so no value of the current day enters (``k=0``, the default, includes it).
    Frames are at most ``max(horizons)`` rows, so the per-row cost is bounded.
    """
    order = Window.partitionBy(item_col).orderBy(date_col)
    w = order.rowsBetween(-(h - 1) - lag_days, -lag_days)
    # the frame holds exactly h rows once the item has h + lag_days rows up to this one
    full = F.row_number().over(order) >= F.lit(h + lag_days)

    def s(c: str) -> Column:
        return F.sum(c).over(w)

    def strict_sum(c: str) -> Column:
        return F.when(full, s(c)).otherwise(F.lit(0))

    day_orders, day_qty, day_rev = s("day_order_count_1d"), s("day_total_quantity_1d"), s("day_total_revenue_1d")
    item_orders, item_qty, item_rev = s("dish_count_in_order_1d"), s("dish_total_quantity_1d"), s("dish_revenue_day_1d")
    return [
        strict_sum("day_order_count_1d").alias(f"day_order_count_{h}d"),
        strict_sum("day_total_quantity_1d").alias(f"day_total_quantity_{h}d"),
        strict_sum("day_total_revenue_1d").alias(f"day_total_revenue_{h}d"),
        strict_ratio(day_qty, day_orders, full).alias(f"avg_order_size_{h}d"),
        strict_sum("day_order_variety_1d").alias(f"day_order_variety_{h}d"),
        strict_sum("dish_count_in_order_1d").alias(f"dish_count_in_order_{h}d"),
        strict_ratio(item_qty, item_orders, full).alias(f"dish_quantity_in_order_avg_{h}d"),
        strict_ratio(item_qty, day_qty, full).alias(f"dish_sales_ratio_daily_{h}d"),
        strict_ratio(item_orders, day_orders, full).alias(f"dish_order_ratio_daily_{h}d"),
        strict_ratio(item_rev, day_rev, full).alias(f"dish_revenue_ratio_daily_{h}d"),
        F.when(full, F.avg("dish_order_size_ratio_1d").over(w)).otherwise(F.lit(0.0))
         .alias(f"dish_order_size_ratio_{h}d"),
    ]


def rolling_features(share: DataFrame, horizons: tuple[int, ...] = HORIZONS,
                     item_col: str = "dish_name", date_col: str = "time_date",
                     lag_days: int = 0) -> DataFrame:
    """All rolling columns for all horizons in one projection (one Window operator).

    With ``lag_days=k`` the 1-day feature columns are also taken from ``k`` rows earlier
    (NULL for the first ``k`` rows of an item), so that no value of the predicted day,
    including ``dish_total_quantity_1d`` (equal to the target), is a feature; ``y_sales``
    itself stays the current day's value."""
    one_day = [c for c in ITEM_1D + CONTEXT_1D + SHARE_1D if c != "y_sales"]
    if lag_days > 0:
        order = Window.partitionBy(item_col).orderBy(date_col)
        moved = [F.lag(c, lag_days).over(order).alias(c) for c in one_day]
    else:
        moved = [F.col(c) for c in one_day]
    base = [F.col(item_col), F.col(date_col), F.col("y_sales"), *moved]
    rolled = [c for h in horizons
              for c in cached(("rolling", h, item_col, date_col, lag_days),
                              lambda h=h: rolling_columns(h, item_col, date_col, lag_days))]
    return share.select(*base, *rolled)


def feature_store(star: DataFrame, horizons: tuple[int, ...] = HORIZONS, item_col: str = "dish_name",
                  date_col: str = "time_date", items: list[str] | None = None,
                  lag_days: int = 0) -> DataFrame:
    """Order-line star (``star_join``) -> 60 feature columns per item-day."""
    share = daily_item_with_context(star, item_col, date_col, items)
    return rolling_features(share, horizons, item_col, date_col, lag_days)


def chrono_split(df: DataFrame, item_col: str = "dish_name", date_col: str = "time_date",
                 train: float = TRAIN_FRACTION, valid: float = VALID_FRACTION) -> DataFrame:
    """Chronological split per item by row position: the first ``floor(n*train)`` rows are
    ``train``, the next ``floor(n*valid)`` ``valid``, the rest ``test``.  The window holds
    one row per item-day, so its partitions stay small."""
    ordered = Window.partitionBy(item_col).orderBy(date_col)
    whole = Window.partitionBy(item_col)
    n = F.count(F.lit(1)).over(whole)
    rn = F.row_number().over(ordered)
    n_train = F.floor(n * F.lit(float(train)))
    n_valid = F.floor(n * F.lit(float(valid)))
    split = (F.when(rn <= n_train, F.lit("train"))
             .when(rn <= n_train + n_valid, F.lit("valid"))
             .otherwise(F.lit("test")))
    return df.withColumn("split", split)
