"""Stand-in star tables built from the TPC-H-like test tables.

    order        <- orders    (o_orderkey, o_totalprice, o_orderdate) + quantity = sum of the
                               order's line quantities
    order_detail <- lineitem  (l_orderkey, l_partkey, l_quantity, l_extendedprice)
    dish         <- part      (p_partkey, p_brand as the item name, p_retailprice)

Money is held as BIGINT minor units (cents: ``round(price * 100)``), like the integer prices of
the original tables, and quantities as BIGINT, so every sum is exact and stays on fast
fixed-width arithmetic (no BigDecimal in aggregation or window buffers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources import files

# Above WHOLE_LINES order lines, a task of the star holds about TASK_LINES of them however many there are:
# its sorts and distinct counts keep a fixed memory, where coalesced partitions grow with the tables.
WHOLE_LINES, TASK_LINES = 2_000_000, 250_000


def task_count(lines: int) -> int | None:
    """Tasks for that many order lines (None: few enough to leave to Spark)."""
    return -(-lines // TASK_LINES) if lines > WHOLE_LINES else None


def spread(df: DataFrame, parts: int | None, key: str) -> DataFrame:
    return df if parts is None else df.repartition(parts, key)


def cents(col: str):
    """Price with two decimals -> exact BIGINT minor units."""
    return F.round(F.col(col) * F.lit(100)).cast("bigint")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as its files are now: nothing is kept between calls."""
    return files.read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet")


def order_table(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Clean ``order``: order_id, time, total_price, quantity, time_date, time_hour; with ``parts``, dealt
    by order_id to that many tasks."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("time"),
        cents("o_totalprice").alias("total_price"),
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_quantity")
    qty = (spread(lines, parts, "order_id").groupBy("order_id")
           .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")))
    return (spread(orders, parts, "order_id").join(qty, on="order_id", how="left")
            .select("order_id", "time", "total_price",
                    F.coalesce("quantity", F.lit(0).cast("bigint")).alias("quantity"),
                    F.to_date("time").alias("time_date"),
                    F.hour("time").alias("time_hour")))


def order_detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ``order_detail``: order_id, dish_id, quantity, price (line total)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("dish_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        cents("l_extendedprice").alias("price"),
    )


def dish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ``dish``: dish_id, dish_name, price (unit price)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("dish_id"),
        F.col("p_brand").alias("dish_name"),
        cents("p_retailprice").alias("price"),
    )


def star_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Order, order_detail and dish; many lines and their orders are dealt by order_id (the lines are counted
    from the file footers)."""
    parts = task_count(table(spark, sf_dir, "lineitem").count())
    return order_table(spark, sf_dir, parts), spread(order_detail_table(spark, sf_dir), parts, "order_id"), dish_table(spark, sf_dir)
