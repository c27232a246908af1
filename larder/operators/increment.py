"""A feature store that grows by days: each new batch of days reads only its own order lines.

The rolling columns of a new row need its item's last ``max(horizons) - 1 + lag_days`` rows, so that
many one-day rows an item are carried over from batch to batch.  A batch is the days after the newest
stored one up to a given day; it joins the carried rows to its own, computes the windows, keeps its own
rows and carries the last rows on.  Its work is its lines plus a bounded number of rows an item, however
long the history is, and every row equals the one that ``features.feature_store`` computes over all days.

Layout below ``root`` (one store for each choice of horizons and lag, which name its folder)::

    rows/upto=<day>     feature rows of one batch, ranged and sorted by item and day (an item's rows
                        lie together, so the row-group statistics let a reader skip the others)
    carry/upto=<day>    the carried one-day rows after that batch, written last

A batch exists once its carry is complete.  Where a job or its driver is lost before that, readers still see the
old store, and the next ``append_days`` writes the unfinished batch anew.

Defined results: lines without a day belong to no batch.  A batch without lines moves the store's day on
and carries the same rows.  Lines that arrive for days already stored change nothing until ``rewind``
takes the store back before them.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.features import (CONTEXT_1D, HORIZONS, ITEM_1D, SHARE_1D, daily_item_with_context,
                                       rolling_features)
from larder.session import delete_path


def store_folder(root: str, horizons: tuple[int, ...] = HORIZONS, lag_days: int = 0) -> str:
    """Where ``root`` keeps the store of these settings."""
    return f"{root.rstrip('/')}/horizons={'-'.join(map(str, horizons))}_lag={lag_days}"


def stored_days(spark: SparkSession, folder: str) -> list[dt.date]:
    """The last days of the finished batches, ascending (one a batch, listed from the store)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/carry")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
    success = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(dt.date.fromisoformat(p.getName().removeprefix("upto="))
                  for p in done if fs.exists(success(p, "_SUCCESS")))


def append_days(star: DataFrame, root: str, last: dt.date, horizons: tuple[int, ...] = HORIZONS,
                item_col: str = "dish_name", date_col: str = "time_date",
                items: list[str] | None = None, lag_days: int = 0) -> dt.date | None:
    """Add the days after the newest stored one up to and with ``last``; returns the day the store
    stood at before (None: it was empty).  ``star`` may hold any days: the others are filtered out
    before the join where the source allows it."""
    spark, folder = star.sparkSession, store_folder(root, horizons, lag_days)
    days = stored_days(spark, folder)
    before = days[-1] if days else None
    if before is not None and last <= before:
        raise ValueError(f"the store already reaches {before}; rewind it to redo days")
    new = F.col(date_col) <= F.lit(last)
    if before is not None:
        new = new & (F.col(date_col) > F.lit(before))
    columns = [item_col, date_col, *ITEM_1D, *CONTEXT_1D, *SHARE_1D]
    share = daily_item_with_context(star.where(new), item_col, date_col, items).select(*columns)

    # the batch's one-day rows are needed twice (features, carry): written once, as part of the carry
    known = f"{folder}/batch/upto={last.isoformat()}"
    if before is not None:
        old = spark.read.parquet(f"{folder}/carry/upto={before.isoformat()}").select(*columns)
        share = old.unionByName(share)
    share.write.mode("overwrite").parquet(known)
    share = spark.read.parquet(known)

    features = rolling_features(share, horizons, item_col, date_col, lag_days)
    if before is not None:
        features = features.where(F.col(date_col) > F.lit(before))
    (features.repartitionByRange(item_col, date_col).sortWithinPartitions(item_col, date_col)
     .write.mode("overwrite").parquet(f"{folder}/rows/upto={last.isoformat()}"))

    carried = max(horizons) - 1 + lag_days
    newest = Window.partitionBy(item_col).orderBy(F.desc(date_col))
    (share.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= carried).drop("_age")
     .write.mode("overwrite").parquet(f"{folder}/carry/upto={last.isoformat()}"))
    delete_path(spark, known)
    return before


def read_store(spark: SparkSession, root: str, horizons: tuple[int, ...] = HORIZONS, lag_days: int = 0) -> DataFrame:
    """All feature rows of the finished batches."""
    folder = store_folder(root, horizons, lag_days)
    days = stored_days(spark, folder)
    if not days:
        raise ValueError(f"{folder} holds no finished batch")
    return spark.read.parquet(*[f"{folder}/rows/upto={d.isoformat()}" for d in days])


def rewind(spark: SparkSession, root: str, day: dt.date | None, horizons: tuple[int, ...] = HORIZONS,
           lag_days: int = 0) -> dt.date | None:
    """Forget every batch that ends after ``day`` (None: all), newest first, so that a rewind that is
    lost half-way leaves a shorter, whole store; returns the day the store then stands at."""
    folder = store_folder(root, horizons, lag_days)
    days = stored_days(spark, folder)
    for d in reversed(days):
        if day is None or d > day:
            delete_path(spark, f"{folder}/carry/upto={d.isoformat()}")
            delete_path(spark, f"{folder}/rows/upto={d.isoformat()}")
    left = [d for d in days if day is not None and d <= day]
    return left[-1] if left else None
