"""Approximate nearest neighbours over shifted space-filling curves.

Every distinct vector is projected several times at random, and each projection, shifted and
quantised, gets its Hilbert key.  Spark range-partitions each curve's keys into blocks of equal
size; a query's window is its own block and the neighbouring ones of every curve.  All rows of the
windows are reranked by exact cosine in double precision, and the windows are merged.

Windows are a share of the data (``(2 * reach + 1) / blocks`` of each curve), so recall does not
fall as the data grow.  Blocks are cut into chunks of bounded size, and so are the queries that
meet them, so no task holds more than one chunk of each.

Defined results
    Vectors that are NULL, zero, hold a NULL or non-finite component, or differ in length from
    the commonest length (ties: the longer) take no part, neither as query nor as candidate.
    NULL vec_id: no part.  Rows repeated in id and vector are one row.  Equal vectors are searched
    once, with their smallest ids; equal cosines go to the smaller vec_id.  Empty table: empty
    result.  Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import common as C


@dataclass(frozen=True)
class NearestParams:
    k: int = 5
    curves: int = 16
    #: Projected dimensions and bits of each: one key has dimensions * bits <= 63 bits.
    dimensions: int = 8
    bits: int = 7
    #: Blocks of a curve, and the neighbouring blocks on either side of a query's own.
    blocks: int = 32
    reach: int = 1
    #: Rows of a block and queries that one task compares at once.
    chunk: int = 20_000
    seed: int = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve positions of integer points (rows), coordinates below 2 ** bits: Gray-code
    untangling from the highest bit down, then bit interleaving."""
    x = [c.astype(np.int64) for c in cells.T]
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            swap = (x[0] ^ x[i]) & low
            inverted = (x[i] & q) != 0
            first = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] = np.where(inverted, x[i], x[i] ^ swap)
            x[0] = first
        q >>= 1
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[d - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | (((x[i] ^ flip) >> b) & 1)
    return key


def usable(vector: str = "embedding") -> Column:
    """No NULL, no NULL or non-finite component, not zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(gid, embedding, ids): each distinct vector once, named by its smallest id, with its
    ``keep`` smallest ids; a row beyond those can be nobody's near row.  Ranks are limited before
    the shuffle, so copies of one vector never gather in one task."""
    by = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("_rank", F.dense_rank().over(by)).where(F.col("_rank") <= keep)
    return (few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
            .select(F.col("ids")[0].alias("gid"), "embedding", "ids"))


def _moments(d: int):
    def run(batches):
        n, s, ss = 0, np.zeros(d), np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            n, s, ss = n + len(x), s + x.sum(0), ss + x.T @ x
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(d + 1)), "row": pa.array(
            [[float(n), *s.tolist()]] + [[0.0, *r] for r in ss.tolist()], pa.list_(pa.float64()))})
    return run


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def curve_keys(vectors: DataFrame, d: int, params: NearestParams) -> DataFrame:
    """(gid, curve, key) of every distinct vector on every curve."""
    moments = np.zeros((d + 1, d + 1))
    for r in (vectors.select("embedding").mapInArrow(_moments(d), "i long, row array<double>")
              .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()):
        moments[r["i"], r["j"]] = r["v"]
    n = max(moments[0, 0], 1.0)
    mean = moments[0, 1:] / n
    cover = moments[1:, 1:] / n - np.outer(mean, mean)
    rng = np.random.Generator(np.random.PCG64(params.seed))
    m = min(params.dimensions, d)
    views = []
    for _ in range(params.curves):
        turn = np.linalg.qr(rng.standard_normal((d, m)))[0]
        spread = 3 * np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turn, cover, turn), 1e-18))
        views.append((turn, mean @ turn, spread, rng.uniform(0, 0.5, m)))
    top = 1 << params.bits

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            for curve, (turn, centre, spread, shift) in enumerate(views):
                # three standard deviations fill half the cube; the shift moves them about in it
                at = np.clip((((x @ turn - centre) / spread + 1) / 4 + shift) * top, 0, top - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(x), curve, np.int32)), pa.array(hilbert_keys(at.astype(np.int64), params.bits))],
                    ["gid", "curve", "key"])

    return vectors.select("gid", "embedding").mapInArrow(run, "gid long, curve int, key long")


def _compare(d: int, keep: int):
    """Top rows of one chunk for the queries that meet it."""
    schema = pa.schema([("query", pa.int64()), ("gid", pa.int64()), ("score", pa.float64())])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.Table.from_pylist([], schema)
        if not left.num_rows or not right.num_rows:
            return empty
        rows = _matrix(left["embedding"].combine_chunks(), d)
        ids = left["gid"].to_numpy()
        # ties keep the smaller id: candidates in order of id, and a stable choice
        order = np.argsort(ids, kind="stable")
        rows, ids = rows[order], ids[order]
        length = np.sqrt((rows * rows).sum(1))
        asked = _matrix(right["asked"].combine_chunks(), d)
        query = right["query"].to_numpy()
        out = []
        for start in range(0, len(asked), 256):
            a = asked[start:start + 256]
            near = (a @ rows.T) / np.sqrt((a * a).sum(1))[:, None] / length
            take = min(2 * keep, len(ids))
            border = -np.partition(-near, take - 1, axis=1)[:, take - 1]
            # rows within rounding error of the border may tie with it
            error = 4 * (d + 8) * np.finfo(float).eps
            for i in range(len(a)):
                # the measure itself, summed in one fixed order for every pair
                pick = np.flatnonzero(~(near[i] < border[i] - error))
                score = (rows[pick] * a[i]).sum(1) / (np.sqrt((a[i] * a[i]).sum()) * length[pick])
                first = np.argsort(-score, kind="stable")[:keep]
                out.append((np.full(len(first), query[start + i]), ids[pick[first]], score[first]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return run


def nearest(embeddings: DataFrame, is_query: Column, params: NearestParams = NearestParams()) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``embeddings`` (vec_id, embedding) that
    ``is_query`` marks, against all other rows."""
    spark = embeddings.sparkSession
    scratch = C.Scratch(spark, "nearest")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & usable())
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = int(lengths[0]["d"]) if lengths else 1
    rows = rows.where(F.size("embedding") == d)
    keep = params.k + 1
    vectors = scratch.keep(distinct_vectors(rows, keep), "vectors")
    queries = scratch.keep(rows.where(is_query).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
                           .join(vectors.select("gid", "embedding"), "embedding").select("query_id", "gid"), "queries")

    # one range partition is one block: neighbouring partitions hold neighbouring keys
    ranges = curve_keys(vectors, d, params).repartitionByRange(params.curves * params.blocks, "curve", "key", "gid")
    blocks = scratch.keep(ranges.select("gid", "curve", F.spark_partition_id().alias("block")), "blocks")
    pieces = max(1, -(-vectors.count() // (params.blocks * params.chunk)))
    piece = lambda c: F.pmod(F.xxhash64(c), F.lit(pieces))
    cells = blocks.join(vectors.select("gid", "embedding"), "gid").select("curve", "block", piece("gid").alias("piece"), "gid", "embedding")
    asked = blocks.join(queries.select("gid").distinct(), "gid").join(vectors.select("gid", "embedding"), "gid")
    reach = F.sequence(F.col("block") - params.reach, F.col("block") + params.reach)
    many = max(1, -(-queries.count() * (2 * params.reach + 1) // (params.blocks * params.chunk)))
    asked = (asked.withColumn("block", F.explode(reach)).withColumn("part", F.pmod(F.xxhash64("gid", F.lit(1)), F.lit(many)))
             .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long")))))
    cells = cells.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))))
    cell = ["curve", "block", "piece", "part"]
    asked = asked.select(*[F.col(c).alias(f"asked_{c}") for c in cell], F.col("gid").alias("query"), F.col("embedding").alias("asked"))
    found = (cells.groupBy(*cell).cogroup(asked.groupBy(*[f"asked_{c}" for c in cell]))
             .applyInArrow(_compare(d, keep), "query long, gid long, score double"))
    merged = found.groupBy("query", "gid").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "gid")
    top = merged.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= keep).select("query", "gid", "score")
    # back to rows: each distinct vector stands for its smallest ids, the query's own excepted
    out = (queries.withColumnRenamed("gid", "query").join(top, "query").join(vectors.select("gid", "ids"), "gid")
           .withColumn("vec_id", F.explode("ids")).where((F.col("vec_id") != F.col("query_id")) | (F.col("gid") != F.col("query"))))
    final = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= params.k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
