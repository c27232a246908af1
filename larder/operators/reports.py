"""Period, item and time-of-day reports (orders, quantity, revenue).

Line-level inputs are aggregated as early as possible: revenue by period first sums each
order's lines (partial aggregation before the shuffle), so the join to the order table is
at order grain instead of line grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.timecols import time_slot

_PERIODS = {"quarter": F.quarter, "month": F.month}


def _period(name: str):
    if name not in _PERIODS:
        raise ValueError(f"Unsupported period: {name}")
    return _PERIODS[name]


def orders_by_period(order: DataFrame, period: str = "quarter", time_col: str = "time") -> DataFrame:
    """Order rows per (year, quarter) or (year, month), in calendar order."""
    p = _period(period)
    return (order.groupBy(F.year(time_col).alias("year"), p(time_col).alias(period))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("year", period))


def revenue_by_period(order_detail: DataFrame, order: DataFrame, period: str = "quarter",
                      time_col: str = "time") -> DataFrame:
    """Revenue = sum(quantity * price) over lines joined (inner) to their order, by quarter
    or month of the order time.  Years are not separated (quarter 1 of every year falls
    together).  ``price`` is read as a unit price here."""
    p = _period(period)
    per_order = (order_detail.groupBy("order_id")
                 .agg(F.sum(F.col("quantity") * F.col("price")).alias("_revenue")))
    return (per_order.join(order.select("order_id", time_col), "order_id")
            .groupBy(p(time_col).alias(period))
            .agg(F.sum("_revenue").alias("total_revenue"))
            .orderBy(period))


def item_sales(order_detail: DataFrame, dish: DataFrame | None = None,
               item_col: str = "dish_name") -> DataFrame:
    """Total quantity and revenue (sum of quantity * price) per item name, best first.

    Without ``dish`` the lines' own name column is used.  With ``dish`` the lines are first
    summed per ``dish_id`` (so the join is at item grain, not line grain) and then named
    from the item table; lines of unknown items are dropped.
    """
    measures = [F.sum("quantity").alias("total_quantity"),
                F.sum(F.col("quantity") * F.col("price")).alias("total_revenue")]
    if dish is None:
        return order_detail.groupBy(item_col).agg(*measures)
    per_id = order_detail.groupBy("dish_id").agg(*measures)
    named = per_id.join(dish.select("dish_id", item_col), "dish_id")
    return named.groupBy(item_col).agg(F.sum("total_quantity").alias("total_quantity"),
                                       F.sum("total_revenue").alias("total_revenue"))


def ranked(df: DataFrame, measure: str, key: str, k: int | None = None) -> DataFrame:
    """Best first by ``measure`` (ties broken by ``key``); optional top-k."""
    out = df.orderBy(F.desc(measure), F.asc(key))
    return out.limit(k) if k is not None else out


def orders_by_slot(order: DataFrame, time_col: str = "time", id_col: str = "order_id") -> DataFrame:
    """Distinct orders per time slot (Morning, Noon, Evening, Night), most first."""
    return (order.groupBy(time_slot(F.hour(time_col)).alias("time_slot"))
            .agg(F.count_distinct(id_col).alias("num_orders"))
            .orderBy(F.desc("num_orders"), F.asc("time_slot")))


def distinct_sorted(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values of ``cols`` in ascending order (e.g. the days or months on offer)."""
    return df.select(*cols).distinct().orderBy(*cols)
