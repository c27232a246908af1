"""Standardisation operators (dedupe, text, numeric, timestamp, accents) and the spec-driven
``standardize``.  All are lazy, row-local projections except ``dedupe`` (one aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.numeric import clean_bigint
from larder.functions.text import clean_text, quoted, strip_accents
from larder.functions.timecols import TIMESTAMP_FORMAT, lenient_timestamp, parse_timestamp
from larder.session import scratch_path
from larder.specs import TableSpec


def dedupe(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column.  Runs as a hash aggregate with map-side combine, so a
    group of many identical copies collapses before the shuffle."""
    return df.dropDuplicates()


def dedupe_wide(df: DataFrame, name: str = "_row_digest") -> DataFrame:
    """``dedupe`` for rows of long texts of which most are single: only 64-bit row digests are shuffled.

    Digests are counted first, and those met twice are written to the shared folder, so that their size is
    known before the rows are planned: below the session's broadcast threshold they are sent to every
    task, beyond it Spark joins them by a shuffle.  Rows whose digest is single are distinct as they
    stand and never leave their task; the others go through ``dropDuplicates``, which compares whole
    values, so two different rows that share a digest both stay.  ``df`` is read three times and has to
    give the same rows each time (a table does).  ``name`` must not be one of its columns."""
    if name in df.columns:
        raise ValueError(f"{name!r} is a column; give another name")
    marked = df.withColumn(name, F.xxhash64(*[F.col(quoted(c)) for c in df.columns]))
    path = scratch_path(df.sparkSession, "row-digests")
    marked.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(name).write.parquet(path)
    again = df.sparkSession.read.parquet(path)
    single = marked.join(again, name, "left_anti").select(*[quoted(c) for c in df.columns])
    shared = marked.join(again, name, "left_semi").select(*[quoted(c) for c in df.columns])
    return single.unionByName(shared.dropDuplicates())


def clean_text_columns(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    present = {c: d for c, d in defaults.items() if c in df.columns}
    return df.withColumns({c: clean_text(c, d) for c, d in present.items()}) if present else df


def clean_numeric_columns(df: DataFrame, defaults: dict[str, int | float],
                          ids: tuple[str, ...] = ()) -> DataFrame:
    present = {c: d for c, d in defaults.items() if c in df.columns and c not in ids}
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema.fields}
    return (df.withColumns({c: clean_bigint(c, d, text=is_text[c]) for c, d in present.items()})
            if present else df)


def parse_timestamp_columns(df: DataFrame, columns: tuple[str, ...],
                            fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Parse each column and add ``{c}_date`` and ``{c}_hour`` next to it; bad text -> NULL.
    Columns that are timestamps or dates already keep their wall-clock time."""
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema.fields}
    for c in [c for c in columns if c in df.columns]:
        df = df.withColumn(c, parse_timestamp(c, fmt, text=is_text[c]))
        df = df.withColumns({f"{c}_date": F.to_date(c), f"{c}_hour": F.hour(c)})
    return df


def strip_accent_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: strip_accents(c) for c in present}) if present else df


def standardize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """dedupe -> text defaults -> numeric defaults -> timestamps -> accent removal.

    The order matters: dedupe runs first (rows equal only after cleaning stay apart) and
    accent removal runs on already-defaulted text, so it may leave ``''``.
    """
    df = dedupe(df)
    df = clean_text_columns(df, spec.text)
    df = clean_numeric_columns(df, spec.numeric, spec.ids)
    df = parse_timestamp_columns(df, spec.timestamps)
    return strip_accent_columns(df, spec.accents)


_DATETIME_TYPES = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def normalize_datetime_columns(df: DataFrame, out_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Columns whose lower-cased name contains ``time`` or ``date`` are parsed leniently and
    re-written as ``out_format`` text (unparseable -> NULL).  Only text, date and timestamp
    columns are touched."""
    targets = [f.name for f in df.schema.fields
               if ("time" in f.name.lower() or "date" in f.name.lower())
               and isinstance(f.dataType, _DATETIME_TYPES)]
    exprs = {}
    for f in df.schema.fields:
        if f.name not in targets:
            continue
        src = F.col(f.name)
        ts = lenient_timestamp(src) if isinstance(f.dataType, T.StringType) else src.cast("timestamp_ntz")
        exprs[f.name] = F.date_format(ts, out_format)
    return df.withColumns(exprs) if exprs else df
