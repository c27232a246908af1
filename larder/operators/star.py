"""The order-line star: ``order_detail ⋈ order ⋈ dish`` at order-line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame

STAR_COLUMNS = (
    "dish_id", "order_id", "dish_quantity", "price_total_dish", "order_quantity",
    "order_total_price", "time_date", "time_hour", "dish_name", "price_one_dish",
)


def star_join(order: DataFrame, order_detail: DataFrame, dish: DataFrame) -> DataFrame:
    """Join clean order lines to their order (inner, on ``order_id``) and to the item
    dimension (left, on ``dish_id``; an unknown item gets a NULL name).

    Inputs are the cleaned tables (``order`` carries ``time_date``/``time_hour``).  Only the
    columns the star needs are kept, so Parquet scans read nothing else.  No join hint is
    given: the item dimension is broadcast when Spark's size estimate (or AQE's runtime
    measurement) is under the broadcast threshold, and sort-merged otherwise; a skewed
    ``order_id`` or ``dish_id`` partition is split by AQE's skew-join handling.
    """
    orders = (order
              .withColumnsRenamed({"quantity": "order_quantity", "total_price": "order_total_price"})
              .select("order_id", "order_quantity", "order_total_price", "time_date", "time_hour"))
    lines = (order_detail
             .withColumnsRenamed({"quantity": "dish_quantity", "price": "price_total_dish"})
             .select("order_id", "dish_id", "dish_quantity", "price_total_dish"))
    items = (dish.withColumnRenamed("price", "price_one_dish")
             .select("dish_id", "dish_name", "price_one_dish"))
    return (lines.join(orders, on="order_id", how="inner")
            .join(items, on="dish_id", how="left")
            .select(*STAR_COLUMNS))
