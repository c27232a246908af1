"""Data profiling: every profile is ONE aggregation job over the input (no per-column or
per-pair jobs), reshaped to a long table with ``explode`` of a literal array of structs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.text import quoted

# Types counted as numeric by the profiler (Short, Byte and Decimal are not), and the
# statistics of the numeric profile with their column suffixes.
NUMERIC_TYPES = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)
STATISTICS = (("minimum", F.min), ("maximum", F.max), ("avg", F.avg), ("std", F.stddev_samp))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long(agg_row: DataFrame, entries: list[tuple[str, list]]) -> DataFrame:
    """One aggregated row -> one output row per entry (column name + expressions)."""
    structs = [F.struct(F.lit(name).alias("column_name"), *exprs) for name, exprs in entries]
    return agg_row.select(F.explode(F.array(*structs)).alias("_e")).select("_e.*")


def basic_profile(df: DataFrame) -> DataFrame:
    """(column_name, dtype, position, num_rows, num_columns): one row per column."""
    fields = df.schema.fields
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    return _long(counted, [(f.name, [F.lit(f.dataType.simpleString()).alias("dtype"),
                                     F.lit(i + 1).alias("position"),
                                     F.col("_n").alias("num_rows"),
                                     F.lit(len(fields)).alias("num_columns")])
                           for i, f in enumerate(fields)])


def missing_percentage(df: DataFrame) -> DataFrame:
    """(column_name, missing_pct): percentage of NULLs (NaN is not missing), rounded half-up
    to 2 decimals with integer arithmetic; NULL for an empty input."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(quoted(c)).alias(f"_c{i}") for i, c in enumerate(cols)]
    counted = df.agg(*aggs)
    n = F.col("_n")
    return _long(counted, [(c, [F.when(n > 0, F.expr(f"(20000 * (_n - _c{i}) + _n) div (2 * _n)")
                                      .cast("double") / F.lit(100.0)).alias("missing_pct")])
                           for i, c in enumerate(cols)])


def numeric_profile(df: DataFrame) -> DataFrame:
    """One wide row: ``{c}_minimum, {c}_maximum, {c}_avg, {c}_std`` (sample standard
    deviation) for every numeric column; no numeric column -> an empty DataFrame."""
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], T.StructType([]))
    return df.agg(*[measure(quoted(c)).alias(f"{c}_{suffix}") for c in cols for suffix, measure in STATISTICS])


#: Values longer than this many characters are counted by their SHA-256 digest.
DIGEST_OVER = 64


def _value_key(c: str) -> Column:
    """A value itself, or where it is long its digest (one sign longer than any value kept as it is, so
    the two never meet)."""
    v = F.col(quoted(c))
    return F.when(F.length(v) <= DIGEST_OVER, v).otherwise(F.concat(F.lit("#"), F.sha2(v, 256)))


def cardinality(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """(column_name, n_distinct) for every string column; NULL counts as one value.

    Exact counts take one shuffle of (column, short value): each task keeps a pair once before it is
    sent, so what travels is bounded by the distinct values of a task and not by the width of the rows.
    ``approx=True`` uses HyperLogLog++ (relative error ``rsd``) for very wide or large data."""
    cols = string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_distinct bigint")
    if approx:
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.approx_count_distinct(quoted(c), rsd).alias(f"_d{i}"), F.max(F.col(quoted(c)).isNull().cast("int")).alias(f"_z{i}")]
        counted = df.agg(*aggs)
        return _long(counted, [(c, [(F.col(f"_d{i}") + F.coalesce(F.col(f"_z{i}"), F.lit(0))).cast("bigint")
                                    .alias("n_distinct")]) for i, c in enumerate(cols)])
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _value_key(c).alias("v")) for i, c in enumerate(cols)])).alias("_e"))
    counted = (pairs.select("_e.i", "_e.v").distinct()
               .agg(*[F.count_if(F.col("i") == F.lit(i)).alias(f"_d{i}") for i in range(len(cols))]))
    return _long(counted, [(c, [F.col(f"_d{i}").cast("bigint").alias("n_distinct")]) for i, c in enumerate(cols)])


def sketches(df: DataFrame, by: str, lg_k: int = 14) -> DataFrame:
    """(part, column_name, sketch, has_null): one mergeable distinct-count sketch of every string column for each
    value of ``by`` (2 ** ``lg_k`` registers: at most some 16 KB).  Store them by part; a new part is sketched alone."""
    cols = [c for c in string_columns(df) if c != by]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.hll_sketch_agg(quoted(c), lg_k).alias(f"_s{i}"), F.max(F.col(quoted(c)).isNull()).alias(f"_z{i}")]
    if not aggs:
        return df.sparkSession.createDataFrame([], "part string, column_name string, sketch binary, has_null boolean")
    each = df.groupBy(F.col(quoted(by)).cast("string").alias("part")).agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("sketch"), F.col(f"_z{i}").alias("has_null")) for i, c in enumerate(cols)]
    return each.select("part", F.explode(F.array(*cells)).alias("_e")).select("part", "_e.*")


def cardinality_of(stored: DataFrame) -> DataFrame:
    """(column_name, n_distinct) estimated over all stored parts; NULL counts as one value."""
    return (stored.groupBy("column_name")
            .agg((F.hll_sketch_estimate(F.hll_union_agg("sketch")) + F.max(F.col("has_null").cast("bigint"))).alias("n_distinct")))


#: Columns up to which every pair is an aggregate of its own, worked out without Python.
PAIR_COLUMNS = 12


def correlations(df: DataFrame) -> DataFrame:
    """(pair, corr) for every pair ``c1__c2`` of numeric columns (i < j), Pearson, NULL read
    as 0.0.  A constant column or an empty input gives NULL instead of failing.

    One aggregation, nothing runs before the result is asked for: a ``corr`` a pair for few columns, the
    mergeable states of ``moments`` for many."""
    cols = numeric_columns(df)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "pair string, corr double")
    if len(cols) > PAIR_COLUMNS:
        return correlations_of(merge_moments(moments(df)))
    value = [F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) for c in cols]
    # centred moments: ``corr`` itself fails on a constant column under ANSI
    # and its variance, merged from partial means, may miss 0 by a rounding
    whole = df.agg(*[F.when(F.min(v) < F.max(v), F.var_pop(v)).alias(f"_v{i}") for i, v in enumerate(value)],
                   *[F.covar_pop(value[i], value[j]).alias(f"_r{i}_{j}") for i, j in pairs])
    cell = lambda i, j: F.try_divide(F.col(f"_r{i}_{j}"), F.sqrt(F.col(f"_v{i}")) * F.sqrt(F.col(f"_v{j}")))
    named = [F.struct(F.lit(f"{cols[i]}__{cols[j]}").alias("pair"), F.nanvl(cell(i, j), F.lit(None).cast("double")).alias("corr")) for i, j in pairs]
    return whole.select(F.explode(F.array(*named)).alias("_e")).select("_e.*")


# ---- mergeable state ------------------------------------------------------------------------
#
# A profile of a growing table is kept as one small state a partition (or day): rows, present values,
# extremes, means and centred co-moments of its numeric columns.  States of different parts merge
# without reading any part again.

STATE = "columns array<string>, rows long, present array<long>, lowest array<double>, highest array<double>, means array<double>, comoments array<double>, zero_means array<double>, zero_comoments array<double>"


def _state(names: list[str], x: np.ndarray) -> dict:
    """The state of the rows ``x`` (NaN: missing).  Single-column figures skip missing values, those of
    pairs read them as 0."""
    there = ~np.isnan(x)
    present = there.sum(0)
    zero = np.where(there, x, 0.0)
    means = np.divide(zero.sum(0), present, out=np.zeros(x.shape[1]), where=present > 0)
    own = ((np.where(there, x - means, 0.0)) ** 2).sum(0)
    # a constant column has exactly its value as mean, so that its co-moments are exactly 0
    zero_means = np.where(zero.min(0) == zero.max(0), zero[0], zero.mean(0)) if len(x) else np.zeros(x.shape[1])
    centred = zero - zero_means
    with np.errstate(all="ignore"):
        low = np.where(present > 0, np.where(there, x, np.inf).min(0, initial=np.inf), np.nan)
        high = np.where(present > 0, np.where(there, x, -np.inf).max(0, initial=-np.inf), np.nan)
    return {"columns": names, "rows": len(x), "present": present, "lowest": low, "highest": high, "means": means, "comoments": own,
            "zero_means": zero_means, "zero_comoments": (centred.T @ centred).ravel()}


def _merged(a: dict, b: dict) -> dict:
    """The state of two parts together (pairwise update of means and centred moments)."""
    na, nb = a["present"], b["present"]
    n = np.maximum(na + nb, 1)
    d = b["means"] - a["means"]
    rows = max(a["rows"] + b["rows"], 1)
    zero_d = b["zero_means"] - a["zero_means"]
    return {"columns": a["columns"], "rows": a["rows"] + b["rows"], "present": na + nb, "lowest": np.fmin(a["lowest"], b["lowest"]),
            "highest": np.fmax(a["highest"], b["highest"]), "means": a["means"] + d * nb / n, "comoments": a["comoments"] + b["comoments"] + d * d * na * nb / n,
            "zero_means": a["zero_means"] + zero_d * b["rows"] / rows,
            "zero_comoments": a["zero_comoments"] + b["zero_comoments"] + np.outer(zero_d, zero_d).ravel() * a["rows"] * b["rows"] / rows}


def _state_table(state: dict, keys: dict | None = None) -> pa.RecordBatch:
    lists = {"columns": pa.list_(pa.string()), "present": pa.list_(pa.int64()), "rows": pa.int64()}
    return pa.RecordBatch.from_pydict({**(keys or {}), **{k: pa.array([v.tolist() if isinstance(v, np.ndarray) else v], lists.get(k, pa.list_(pa.float64())))
                                                          for k, v in state.items()}})


def _state_of(row: dict) -> dict:
    return {k: v if k in ("columns", "rows") else np.array([np.nan if c is None else c for c in v], np.int64 if k == "present" else float) for k, v in row.items()}


def moments(df: DataFrame, by: str | None = None) -> DataFrame:
    """One state a task, or a task and value of ``by``: merge them with ``merge_moments``, or store them first."""
    cols = [c for c in numeric_columns(df) if c != by]
    key = [F.col(quoted(by)).cast("string").alias("part")] if by else [F.lit("").alias("part")]
    rows = df.select(*key, *[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches):
        found: dict = {}
        for batch in batches:
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(cols))]) if cols else np.zeros((batch.num_rows, 0))
            part = batch.column(0).dictionary_encode()
            at = part.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for code in np.unique(at).tolist():
                name = part.dictionary[code].as_py() if code >= 0 else None
                state = _state(cols, x[at == code])
                found[name] = _merged(found[name], state) if name in found else state
        for name, state in found.items():
            yield _state_table(state, {"part": pa.array([name], pa.string())})

    return rows.mapInArrow(run, f"part string, {STATE}")


def merge_moments(states: DataFrame, by_part: bool = False) -> DataFrame:
    """States merged into one, or into one a part."""
    rows = states if by_part else states.withColumn("part", F.lit(""))

    def run(table: pa.Table) -> pa.Table:
        out = None
        for row in table.to_pylist():
            part = row.pop("part")
            out = _state_of(row) if out is None else _merged(out, _state_of(row))
        return pa.Table.from_batches([_state_table(out, {"part": pa.array([part], pa.string())})])

    return rows.groupBy("part").applyInArrow(run, f"part string, {STATE}")


def numeric_profile_of(merged: DataFrame) -> DataFrame:
    """(part, column_name, minimum, maximum, avg, std, missing) from merged states."""
    each = merged.select("part", "rows", F.explode(F.arrays_zip("columns", "present", "lowest", "highest", "means", "comoments")).alias("e"))
    n = F.col("e.present")
    some = lambda c: F.when(n > 0, F.col(f"e.{c}"))
    return each.select("part", F.col("e.columns").alias("column_name"), some("lowest").alias("minimum"), some("highest").alias("maximum"), some("means").alias("avg"),
                       F.when(n > 1, F.sqrt(F.col("e.comoments") / (n - 1))).alias("std"), (F.col("rows") - n).alias("missing"))


def correlations_of(merged: DataFrame) -> DataFrame:
    """(pair, corr) from one merged state: every pair i < j, NULL for a constant column."""
    cells = merged.select("columns", "zero_comoments", F.size("columns").alias("k"), F.posexplode("columns").alias("i", "a"))
    cells = cells.select("columns", "zero_comoments", "k", "i", "a", F.posexplode("columns").alias("j", "b")).where("i < j")
    at = lambda i, j: F.element_at("zero_comoments", (F.col(i) * F.col("k") + F.col(j) + 1).cast("int"))
    return cells.select(F.concat("a", F.lit("__"), "b").alias("pair"), F.try_divide(at("i", "j"), F.sqrt(at("i", "i") * at("j", "j"))).alias("corr"))
