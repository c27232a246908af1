"""Database extract over JDBC: list the tables of a schema, read each one in parallel
slices, normalise its date/time columns and land it as files.

Credentials are passed in by the caller (``properties``) and never stored here.  The JDBC
driver jar must be on the cluster's classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.operators.clean import normalize_datetime_columns
from larder.sources.files import write_table


def list_tables(spark: SparkSession, url: str, schema: str, properties: dict[str, str]) -> DataFrame:
    """Names of the base tables of ``schema`` (from ``information_schema.tables``)."""
    query = ("(SELECT table_name FROM information_schema.tables "
             f"WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE') AS t")
    return spark.read.jdbc(url, query, properties=properties)


def column_bounds(spark: SparkSession, url: str, table: str, column: str,
                  properties: dict[str, str]) -> tuple[int | None, int | None]:
    """(MIN, MAX) of a numeric column, computed by the database (one pushed-down query)."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) AS bounds"
    row = spark.read.jdbc(url, query, properties=properties).first()
    return (None, None) if row is None else (row["lo"], row["hi"])


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """``SELECT *`` of one table.  With a numeric ``partition_column`` the read is split into
    ``num_partitions`` range queries that run in parallel (default: the cluster's default
    parallelism); bounds not given are fetched from the database first."""
    props = {"fetchsize": str(fetch_size), **properties}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    if lower_bound is None or upper_bound is None:
        lo, hi = column_bounds(spark, url, table, partition_column, props)
        if lo is None:  # empty table: nothing to split
            return spark.read.jdbc(url, table, properties=props)
        lower_bound = lo if lower_bound is None else lower_bound
        upper_bound = hi if upper_bound is None else upper_bound
    parts = num_partitions or spark.sparkContext.defaultParallelism
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=int(lower_bound),
                           upperBound=int(upper_bound), numPartitions=parts, properties=props)


def extract_tables(spark: SparkSession, url: str, tables: list[str], out_dir: str,
                   properties: dict[str, str], fmt: str = "csv",
                   partitioning: dict[str, dict] | None = None) -> None:
    """Land each table as ``out_dir/<table>`` (overwritten), with every column whose name
    contains ``time`` or ``date`` rewritten as ``yyyy-MM-dd HH:mm:ss`` text.
    ``partitioning`` maps a table to ``read_table`` keyword arguments, e.g.
    ``{"order_detail": {"partition_column": "id"}}`` for a parallel read."""
    for name in tables:
        df = read_table(spark, url, name, properties, **(partitioning or {}).get(name, {}))
        write_table(normalize_datetime_columns(df), f"{out_dir.rstrip('/')}/{name}", fmt)
