"""Forecast evaluation and views: metrics, wide/long prediction tables, month views.

Predictions are kept long, ``(time_date, dish_name, prediction)``; the wide one-column-per-
item layout is produced only at the edge (``to_wide``) and read back with ``to_long``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import display_name, quoted
from larder.functions.timecols import month_key


def regression_metrics(df: DataFrame, label: str = "y_sales", prediction: str = "prediction",
                       item_col: str = "dish_name") -> DataFrame:
    """(item, MAE, RMSE, R2) per item in one aggregation.  R2 = 1 - SSE/SST with
    SST = n * population variance of the label; NULL when the label is constant."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    # rows without a prediction count in neither sum
    scored = F.when(F.col(prediction).isNotNull(), F.col(label).cast("double"))
    sse = F.sum(err * err)
    sst = F.var_pop(scored) * F.count(scored)
    return df.groupBy(item_col).agg(
        F.avg(F.abs(err)).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("R2"),
    )


def mean_baseline(split_df: DataFrame, label: str = "y_sales", item_col: str = "dish_name") -> DataFrame:
    """Predict every row with the mean label of the item's ``train`` rows (a window per
    item, so no join): the reference point any fitted model has to beat."""
    item = Window.partitionBy(item_col)
    train_mean = F.avg(F.when(F.col("split") == F.lit("train"), F.col(label).cast("double"))).over(item)
    return split_df.withColumn("prediction", train_mean)


def to_wide(long_df: DataFrame, columns: dict[str, str], item_col: str = "dish_name",
            value_col: str = "prediction", date_col: str = "time_date") -> DataFrame:
    """Long -> wide, a display format: one row per day and one column per item of ``columns``
    (item name -> column name, the caller's own list), plus the ``yyyyMM`` month.

    Raises for two items with one column name and for a column named like the day or the month;
    the query fails if a day has two values of one item.  Items not listed are left out."""
    names = list(columns.values())
    if len(set(names)) < len(names) or {date_col, "month"} & set(names):
        raise ValueError("column names must be unique and differ from the day and month columns")
    value = (F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two values for one day and item")).cast("double"))
             .otherwise(F.max(F.col(value_col).cast("double"))))
    wide = long_df.groupBy(date_col).pivot(item_col, list(columns)).agg(value)
    wide = wide.select(date_col, *[F.col(quoted(item)).alias(name) for item, name in columns.items()])
    return wide.withColumn("month", month_key(date_col))


def to_long(wide_df: DataFrame, item_col: str = "dish_name", value_col: str = "prediction",
            date_col: str = "time_date", id_cols: tuple[str, ...] = ("month",)) -> DataFrame:
    """Wide -> long.  ``month`` is an id column, never an item; empty cells are dropped."""
    ids = [date_col, *[c for c in id_cols if c in wide_df.columns]]
    values = [F.col(quoted(c)) for c in wide_df.columns if c not in ids]
    return (wide_df.unpivot([F.col(quoted(c)) for c in ids], values, item_col, value_col)
            .where(F.col(value_col).isNotNull()))


def month_mean(long_df: DataFrame, item_col: str = "dish_name", value_col: str = "prediction",
               date_col: str = "time_date") -> DataFrame:
    """Mean value per item and ``yyyyMM`` month (NULLs skipped)."""
    return (long_df.groupBy(month_key(date_col).alias("month"), item_col)
            .agg(F.avg(value_col).alias("month_mean")))


def day_vs_month(long_df: DataFrame, item_col: str = "dish_name", value_col: str = "prediction",
                 date_col: str = "time_date", day: str | None = None, first_only: bool = False) -> DataFrame:
    """Each day's value next to the item's mean over that month, with a display name.
    The window holds one item-month (at most 31 rows).  ``day`` (``yyyy-MM-dd``) keeps one calendar
    day; only its month is read, by partition where the table has a ``month`` column.  ``first_only``
    keeps the first row of each item and day, where days may hold any number of rows: they are
    aggregated before any window, which again sees at most 32 rows an item-month."""
    month = F.col("month") if "month" in long_df.columns else month_key(date_col)
    if day is not None:
        long_df = long_df.where(month == F.lit(day[:7].replace("-", "")))
    if first_only:
        return _first_vs_month(long_df, month, item_col, value_col, date_col, day)
    w = Window.partitionBy(month, F.col(item_col))
    out = long_df.select(
        F.col(date_col), month.alias("month"), F.col(item_col),
        display_name(item_col).alias("display_name"),
        F.col(value_col), F.avg(value_col).over(w).alias("month_mean"))
    if day is not None:
        out = out.where(F.to_date(date_col) == F.lit(day).cast("date"))
    return out


def _first_vs_month(long_df: DataFrame, month: Column, item_col: str, value_col: str, date_col: str,
                    day: str | None) -> DataFrame:
    """One aggregation gives each item-day's first row and, as a further set, each item-month's mean."""
    keyed = long_df.select(F.col(item_col).alias("_item"), month.alias("_month"), F.to_date(date_col).alias("_day"),
                           F.col(value_col).alias("_value"), F.struct(F.col(date_col).alias("d"), F.col(value_col).alias("v")).alias("_row"))
    rows = (keyed.groupingSets([["_item", "_month", "_day"], ["_item", "_month"]], "_item", "_month", "_day")
            .agg(F.grouping("_day").alias("_of_month"), F.min("_row").alias("_row"), F.avg("_value").alias("_mean")))
    whole = F.max(F.when(F.col("_of_month") == 1, F.col("_mean"))).over(Window.partitionBy("_month", "_item"))
    days = rows.withColumn("_mean", whole).where("_of_month = 0")
    if day is not None:
        days = days.where(F.col("_day") == F.lit(day).cast("date"))
    # a day has rows of two months only where the table's own month column says so
    first = Window.partitionBy("_item", "_day").orderBy("_row")
    days = days.withColumn("_place", F.row_number().over(first)).where("_place = 1")
    return days.select(F.col("_row.d").alias(date_col), F.col("_month").alias("month"), F.col("_item").alias(item_col),
                       display_name("_item").alias("display_name"), F.col("_row.v").alias(value_col), F.col("_mean").alias("month_mean"))
