"""Incremental standardisation of arriving files (an extra beside the surveyed operators).

The cleaning expressions (text, numbers, timestamps, accents) are stateless column expressions, so
they run unchanged on a streaming DataFrame.  Whole-row de-duplication is the one stateful step: it
remembers every different row, so that no row is ever dropped for being late, and the result equals
the batch operator's.  ``dedupe=False`` leaves it out where the input is known to have no copies.

Sinks write Parquet with a checkpoint location in the shared checkpoint folder, so a restarted query
(or one that lost executors) resumes exactly once where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larder.operators import clean
from larder.session import checkpoint_dir
from larder.specs import TableSpec


def read_stream(spark: SparkSession, directory: str, schema: T.StructType | str, fmt: str = "csv",
                file_glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of ``directory`` (optionally only names matching ``file_glob``) as a stream.
    A schema is required: streaming sources do not infer."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"Unsupported format: {fmt}")
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return reader.option("header", True).csv(directory)
    return reader.parquet(directory)


def standardize_stream(df: DataFrame, spec: TableSpec, dedupe: bool = True) -> DataFrame:
    """``standardize`` for a stream: the same rows as the batch operator, late ones included."""
    if dedupe:
        df = df.dropDuplicates()
    df = clean.clean_text_columns(df, spec.text)
    df = clean.clean_numeric_columns(df, spec.numeric, spec.ids)
    df = clean.parse_timestamp_columns(df, spec.timestamps)
    return clean.strip_accent_columns(df, spec.accents)


def write_stream(df: DataFrame, path: str, name: str, checkpoint_location: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Append to Parquet at ``path``.  The checkpoint defaults to a folder named after the
    stream under ``spark.checkpoint.dir`` (stable across restarts).  ``available_now``
    processes what has arrived and stops; otherwise the query keeps running."""
    location = checkpoint_location or f"{checkpoint_dir(df.sparkSession)}/streams/{name}"
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", location).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(path)


def run_available(df: DataFrame, path: str, name: str, checkpoint_location: str | None = None) -> DataFrame:
    """Process everything available now, wait for it, and return the sink as a table."""
    query = write_stream(df, path, name, checkpoint_location, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return df.sparkSession.read.parquet(path)


__all__ = ["read_stream", "standardize_stream", "write_stream", "run_available"]
