"""File sources and sinks.

All writes use ``mode("overwrite")`` so that a retried job (after a lost executor or a
failed attempt) replaces, rather than duplicates, its output.  Outputs are Spark folders
(``part-*`` files); nothing is renamed or copied on the driver's local disk.  ``replace_table`` renames whole
folders through the Hadoop file system.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.text import ITEM_KEY_PREFIX, item_key, quoted
from larder.functions.timecols import month_key
from larder.session import delete_path

FORMATS = ("csv", "parquet")


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")


def read_table(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType | str | None = None, null_value: str | None = None) -> DataFrame:
    """CSV (with header) or Parquet.  With a ``schema`` CSV is read without inference (one
    pass over the data fewer, and stable types); without one the types are inferred.

    CSV keeps no difference between NULL and ``''`` by default (both read back as NULL).
    Write and read with the same ``null_value`` (e.g. ``"\\N"``) to keep it."""
    _check(fmt)
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    reader = spark.read.option("header", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


#: Types an inferred CSV column may get, narrowest first: (type, shape of a text, how it is read).  A column gets the
#: first type that reads every text in it, else string; a column without values is a string.
LADDER = (
    ("bigint", r"^[+-]?[0-9]+$", lambda v: v.try_cast("bigint")),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", lambda v: v.try_cast("double")),
    ("boolean", r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$", lambda v: v.try_cast("boolean")),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", lambda v: v.try_cast("date")),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$", lambda v: v.try_cast("timestamp_ntz")),
)
BAD_ROW = "_bad_row"


def csv_texts(spark: SparkSession, path: str, null_value: str | None = None, bad_row: str = BAD_ROW) -> DataFrame:
    """A CSV with header as texts, with one more column: the whole line where it has more or fewer
    fields than the header, else NULL."""
    reader = spark.read.option("header", True).option("enforceSchema", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    names = reader.csv(path).columns  # reads the header line only
    if bad_row in names:
        raise ValueError(f"{bad_row!r} is a column of {path}; give another name")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, bad_row]])
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_row).schema(schema).csv(path)


def infer_types(texts: DataFrame, bad_row: str = BAD_ROW) -> DataFrame:
    """One row (column_name, data_type, n_values) a column, in order: one aggregate over the well-formed lines,
    with a flag for each column and rung of ``LADDER``; nothing is sampled."""
    names = [c for c in texts.columns if c != bad_row]
    good = texts.where(F.col(bad_row).isNull()) if bad_row in texts.columns else texts
    aggs = []
    for i, c in enumerate(names):
        v = F.col(quoted(c))
        aggs.append(F.count(v).alias(f"_n{i}"))
        aggs += [F.bool_and(F.when(v.isNotNull(), v.rlike(shape) & read(v).isNotNull())).alias(f"_f{i}_{j}")
                 for j, (_, shape, read) in enumerate(LADDER)]
    cells = []
    for i, c in enumerate(names):
        kind = F.lit("string")
        for j in reversed(range(len(LADDER))):
            kind = F.when(F.col(f"_f{i}_{j}"), F.lit(LADDER[j][0])).otherwise(kind)
        cells.append(F.struct(F.lit(c).alias("column_name"), kind.alias("data_type"), F.col(f"_n{i}").alias("n_values")))
    if not cells:
        return texts.sparkSession.createDataFrame([], "column_name string, data_type string, n_values bigint")
    return good.agg(*aggs).select(F.explode(F.array(*cells)).alias("_e")).select("_e.*")


def read_inferred(spark: SparkSession, path: str, null_value: str | None = None, bad_row: str = BAD_ROW) -> DataFrame:
    """A CSV with the types that all its well-formed lines allow.  Malformed lines stay as rows: their text in
    ``bad_row``, the fields they have as far as these can be read.  The driver gets one row a column."""
    texts = csv_texts(spark, path, null_value, bad_row)
    read = {kind: how for kind, _, how in LADDER} | {"string": lambda v: v}
    kinds = {r["column_name"]: r["data_type"] for r in infer_types(texts, bad_row).collect()}
    return texts.select(*[read[k](F.col(quoted(c))).alias(c) for c, k in kinds.items()], bad_row)


def write_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False,
                null_value: str | None = None) -> None:
    """Overwrite ``path`` with ``df``.  ``single_file=True`` writes one part file (only for
    small tables such as dimensions: it funnels the data through one task)."""
    _check(fmt)
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        if null_value is not None:
            writer = writer.option("nullValue", null_value)
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_feature_store(features: DataFrame, path: str, item_col: str = "dish_name") -> None:
    """One Parquet partition per item (``dish_key``, one to one with the name).  Rows are
    clustered by item first so each partition folder gets one file per writing task."""
    keyed = features.withColumn("dish_key", item_key(item_col))
    (keyed.repartition("dish_key").write.mode("overwrite")
     .partitionBy("dish_key").parquet(path))


def read_feature_store(spark: SparkSession, path: str, item: str | None = None,
                       date_col: str = "time_date") -> DataFrame:
    """Whole store, or one item's series (partition pruning: only that folder is read).
    Raises ``ValueError`` when the store has no ``date_col``."""
    df = spark.read.option("basePath", path).parquet(path)
    if date_col not in df.columns:
        raise ValueError(f"{path} has no column {date_col!r}")
    if "dish_key" in df.columns:
        df = df.withColumn("dish_key", F.col("dish_key").cast("string"))
    if item is not None:
        df = df.where(F.col("dish_key") == F.lit(ITEM_KEY_PREFIX + item))
    return df


def write_predictions(predictions: DataFrame, path: str, date_col: str = "time_date",
                      item_col: str = "dish_name", num_partitions: int | None = None, only_months: bool = False) -> None:
    """Predictions partitioned by ``yyyyMM`` month, rows sorted by day inside every file.

    Rows are range-partitioned on (month, day, item) rather than hashed on the month, so
    one month (or one day) holding a large share of the rows is split over several writing
    tasks instead of landing in one; each task's files hold a contiguous run of days.

    ``only_months`` replaces the months that ``predictions`` holds and leaves the files of all others
    untouched; otherwise the whole store is replaced."""
    with_month = predictions if "month" in predictions.columns else predictions.withColumn("month", month_key(date_col))
    keys = ["month", date_col] + ([item_col] if item_col in with_month.columns else [])
    ranged = (with_month.repartitionByRange(num_partitions, *keys) if num_partitions
              else with_month.repartitionByRange(*keys))
    (ranged.sortWithinPartitions(*keys[1:])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_months else "static").partitionBy("month").parquet(path))


def read_predictions(spark: SparkSession, path: str, month: str | None = None,
                     schema: T.StructType | str | None = None) -> DataFrame:
    """All months, or one (partition pruning).  A missing store reads as an empty table
    when ``schema`` is given; any other failure is raised."""
    if schema is not None and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(path)
    df = df.withColumn("month", F.col("month").cast("string"))
    return df.where(F.col("month") == F.lit(month)) if month is not None else df


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", null_value: str | None = None) -> None:
    """Replace the table at ``path`` by ``df``, which may read that very table.

    The rows are written beside it first; only a finished write takes the table's place, by two
    renames (old away, new in).  A job that fails, or loses its driver, before that leaves the old table as it
    was; between the renames the old table is kept at ``path`` + ``.old`` and put back by ``recover_table``, which
    every call runs first.  Two writers at once: each writes its own folder, the later rename wins whole."""
    spark = df.sparkSession
    path = path.rstrip("/")
    recover_table(spark, path)
    staged, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    try:
        write_table(df, staged, fmt, null_value=null_value)
        if _exists(spark, path):
            delete_path(spark, old)
            _rename(spark, path, old)
        _rename(spark, staged, path)
    except Exception:
        delete_path(spark, staged)
        recover_table(spark, path)
        raise
    delete_path(spark, old)


def recover_table(spark: SparkSession, path: str) -> None:
    """Put the old table back where a replacement ended between its two renames."""
    old = f"{path.rstrip('/')}.old"
    if _exists(spark, old):
        if _exists(spark, path):
            delete_path(spark, old)
        else:
            _rename(spark, old, path.rstrip("/"))


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_months(predictions: DataFrame) -> DataFrame:
    """The months on offer, ascending."""
    return predictions.select("month").distinct().orderBy("month")
