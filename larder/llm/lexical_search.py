"""Ranked lexical search as dense blocked matrix products.

Documents are read once: each becomes a sparse row of the terms it shares with the queries' vocabulary
(``sparse``), beside counts of documents, terms and document frequencies over the whole corpus.
Queries are cut into tiles; a tile's vocabulary holds its own terms only, so it is compact.  Each
task scatters the impacts of a block of documents into a dense tile and multiplies it with the
tile of query weights in float64 (BLAS).  Weights and impacts are whole numbers and a product sums
so few of them that no partial sum reaches 2 ** 53, so every sum is exact; sums over the column
blocks of a wide vocabulary are added in 64-bit integers.  A running list of the best of each query
prunes a tile: a document comes in only above the k-th score, or at it with a smaller id.

Bounds.  The vocabulary and weights of at most ``batch_terms`` query terms are broadcast at once; more
queries are searched in further passes over the same sparse rows.  A task holds one block of documents
times one query tile.  A text is split in slices of 1 MiB, whatever its length.

Defined results
    NULL or empty text: no terms; such a document is in no count and no result, such a query has no
    rows.  Query rows with one item_id are one query (terms of all its rows).  NULL item_id: a query.
    Repeated documents are documents of their own; a NULL doc_id comes after others of equal score.
    Empty tables: no rows.  Further columns are ignored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import common as C


@dataclass(frozen=True)
class SearchParams:
    k: int = 10
    #: Queries of a tile, documents of a block, columns of a product.
    tile_queries: int = 64
    block_documents: int = 1024
    block_columns: int = 2048
    #: Distinct terms (summed over queries) of one pass.
    batch_terms: int = 100_000


#: Fixed by the query's contract: scales of weights and impacts, and the length part of an impact.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 90
#: No impact reaches this: (10**9 * tf) div (1000 * tf + 8 * m) with m >= 10.
IMPACT_BOUND = IMPACT_SCALE // TF_SCALE

_FOLD = np.full(256, 0x20, np.uint8)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_a:_b + 1] = np.arange(_a, _b + 1)
_FOLD[0x41:0x5B] += 0x20
#: Bytes of terms, A-Z as a-z; any other byte as a space.
FOLD = bytes(_FOLD)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(body: bytes) -> Counter:
    """Occurrences of every term of a UTF-8 text, counted in slices that end between terms."""
    found: Counter = Counter()
    at, n = 0, len(body)
    while at < n:
        end = min(n, at + C.CHUNK_BYTES)
        part = body[at:end].translate(FOLD)
        if end < n:
            cut = part.rfind(b" ") + 1
            while not cut and end < n:  # one term fills the slice
                end = min(n, end + C.CHUNK_BYTES)
                part = body[at:end].translate(FOLD)
                cut = part.rfind(b" ") + 1
            if end < n:
                part, end = part[:cut], at + cut
        found.update(part.split())
        at = end
    return found


def weight(n_documents: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_documents + 2) / (2 * df + 1)))


@dataclass
class Batch:
    """Queries of one pass: their ids, the terms of each as indexes, and the vocabulary."""
    ids: list
    rows: list[list[int]]
    vocabulary: dict[bytes, int]


def query_batches(items: DataFrame, params: SearchParams) -> Iterator[Batch]:
    """The queries in order of id, cut into passes of a bounded number of terms.  One row a query and
    term comes to the driver, as a stream."""
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches):
        for batch in batches:
            for item_id, text in zip(batch.column(0), batch.column(1).to_pylist()):
                found = sorted(terms((text or "").encode()))
                for start in range(0, len(found), 100_000):
                    part = found[start:start + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item_id.as_py()] * len(part), item_id.type), pa.array(part, pa.binary())], ["item_id", "term"])

    rows = items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, term binary").distinct().orderBy("item_id", "term")
    batch = Batch([], [], {})
    size = 0
    for row in rows.toLocalIterator():
        new = not batch.ids or batch.ids[-1] != row["item_id"]
        if new and size >= params.batch_terms:
            yield batch
            batch, size = Batch([], [], {}), 0
        if new:
            batch.ids.append(row["item_id"])
            batch.rows.append([])
        term = bytes(row["term"])
        batch.rows[-1].append(batch.vocabulary.setdefault(term, len(batch.vocabulary)))
        size += 1
    if batch.ids:
        yield batch


def sparse_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n`` (terms with repeats) and the vocabulary's terms in the document as 32-bit indexes and
    counts.  Documents without a term are left out."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, data, offsets in C.chunks(batches, "text"):
            body = data.tobytes()
            kept, sizes, at, counts = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                found = terms(body[a:b])
                if not found:
                    continue
                pairs = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                kept.append(i)
                sizes.append(sum(found.values()))
                at.append(np.array([p[0] for p in pairs], "<i4").tobytes())
                counts.append(np.array([p[1] for p in pairs], "<i8").tobytes())
            ids = part.column(part.schema.get_field_index("doc_id")).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(at, pa.binary()), pa.array(counts, pa.binary())],
                                             ["doc_id", "n", "at", "tf"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, at binary, tf binary")


def document_frequencies(sparse: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary; at most ``size`` rows reach the driver."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in batch.column(0):
                total[np.frombuffer(at.as_buffer(), "<i4")] += 1
        found = np.flatnonzero(total)
        for start in range(0, len(found), 100_000):
            part = found[start:start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["at", "df"])

    out = np.zeros(size, np.int64)
    for row in sparse.select("at").mapInArrow(count, "at int, df long").groupBy("at").agg(F.sum("df").alias("df")).toLocalIterator():
        out[row["at"]] = row["df"]
    return out


@dataclass
class Tile:
    """Some queries over their own terms, ascending: a term's place among them is its column; ``blocks`` are
    the weight matrices of at most ``block_columns`` columns each."""
    first: int
    own: np.ndarray
    blocks: list[np.ndarray]


def tiles(batch: Batch, weights: np.ndarray, params: SearchParams) -> list[Tile]:
    out = []
    # a product's partial sums stay below 2 ** 53 whatever the order of its terms
    widest = int(2 ** 53 // (IMPACT_BOUND * max(1, int(weights.max(initial=1))))) - 1
    width = max(1, min(params.block_columns, widest))
    for first in range(0, len(batch.ids), params.tile_queries):
        rows = batch.rows[first:first + params.tile_queries]
        own = np.unique(np.concatenate([np.array(r, np.int64) for r in rows]))
        dense = np.zeros((len(rows), len(own)))
        for i, r in enumerate(rows):
            dense[i, np.searchsorted(own, r)] = weights[r]
        out.append(Tile(first, own.astype(np.int32), [np.ascontiguousarray(dense[:, a:a + width]) for a in range(0, len(own), width)]))
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest positive scores, equal ones by ascending id, best first.  ``ids`` are in
    ascending order, so a position stands for its id."""
    found = np.flatnonzero(scores > 0)
    if len(found) > k:
        border = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= border]  # every tie at the border
    order = np.argsort(-scores[found], kind="stable")
    return found[order[:k]]


def rank_rows(sparse: DataFrame, batch: Batch, weights: np.ndarray, n_documents: int, n_terms: int, params: SearchParams) -> DataFrame:
    """``item, doc_id, score``: the best of every task for every query of the batch (by its number)."""
    kind = sparse.schema["doc_id"].dataType.simpleString()
    made = tiles(batch, weights, params)
    k, n_queries = params.k, len(batch.ids)

    def run(batches):
        top_score = np.zeros((n_queries, k), np.int64)
        top_id = np.zeros((n_queries, k), np.int64)
        top_null = np.zeros((n_queries, k), bool)

        def block(ids, nulls, sizes, at, tf, owner):
            """One block of documents, in ascending order of id, against every tile."""
            m = 100 - LENGTH_SHARE + np.array([LENGTH_SHARE * int(n) * n_documents // n_terms for n in sizes], np.int64)
            impact = ((IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * m[owner])).astype(np.float64)
            for tile in made:
                column = np.searchsorted(tile.own, at)
                hit = tile.own[np.minimum(column, len(tile.own) - 1)] == at
                column, row, value = column[hit], owner[hit], impact[hit]
                scores = np.zeros((len(tile.blocks[0]), len(ids)), np.int64)
                low = 0
                for dense in tile.blocks:
                    width = dense.shape[1]
                    inside = (column >= low) & (column < low + width)
                    documents = np.zeros((len(ids), width))
                    documents[row[inside], column[inside] - low] = value[inside]  # a document has a term once
                    scores += (dense @ documents.T).astype(np.int64)
                    low += width
                worst = top_score[tile.first:tile.first + len(scores), k - 1]
                # equal to the k-th score may still come in with a smaller id
                for q in np.flatnonzero((scores >= np.maximum(worst, 1)[:, None]).any(1)).tolist():
                    g = tile.first + q
                    own = scores[q]
                    found = best(np.where(own >= worst[q], own, 0), ids, k)
                    s = np.r_[top_score[g], own[found]]
                    i, z = np.r_[top_id[g], ids[found]], np.r_[top_null[g], nulls[found]]
                    order = np.lexsort((i, z, -s))[:k]
                    top_score[g], top_id[g], top_null[g] = s[order], i[order], z[order]

        for part in batches:
            for start in range(0, part.num_rows, params.block_documents):
                cut = part.slice(start, params.block_documents)
                nulls = cut.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = cut.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.lexsort((ids, nulls))
                cells = cut.column(2), cut.column(3)
                at = [np.frombuffer(cells[0][i].as_buffer(), "<i4") for i in order.tolist()]
                tf = [np.frombuffer(cells[1][i].as_buffer(), "<i8") for i in order.tolist()]
                owner = np.repeat(np.arange(len(order)), [len(a) for a in at])
                block(ids[order], nulls[order], cut.column(1).to_numpy()[order], np.concatenate(at), np.concatenate(tf), owner)
        query, place = np.nonzero(top_score > 0)
        if len(query):
            gone = top_null[query, place]
            yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(top_id[query, place], pa.int64(), mask=gone),
                                              pa.array(top_score[query, place])], ["item", "doc_id", "score"])

    found = sparse.mapInArrow(run, "item int, doc_id long, score long")
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).withColumn("doc_id", F.col("doc_id").cast(kind))


def ranked_search(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of ``docs`` (doc_id, text) for every query of
    ``items`` (item_id, text)."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "search")
    kind = items.schema["item_id"].dataType.simpleString()
    ids = docs.schema["doc_id"].dataType.simpleString()
    out = None
    for number, batch in enumerate(query_batches(items, params)):
        sparse = scratch.keep(sparse_rows(docs, batch.vocabulary), f"sparse{number}")
        total = sparse.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not total["n"]:
            break
        df = document_frequencies(sparse, len(batch.vocabulary))
        weights = np.array([weight(total["n"], int(d)) for d in df], np.int64)
        found = rank_rows(sparse, batch, weights, total["n"], int(total["terms"]), params)
        names = spark.createDataFrame([(i, item) for i, item in enumerate(batch.ids)], f"item int, item_id {kind}")
        found = scratch.keep(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), f"found{number}")
        scratch.drop(f"sparse{number}")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {ids}, score long") if out is None else out


def sql(params: SearchParams = SearchParams()) -> str:
    """DuckDB SQL for ``ranked_search`` over ``documents`` and ``benchmark``."""
    fold = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = f"regexp_extract_all({fold}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {split} AS terms FROM documents),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_documents, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
wanted AS (SELECT DISTINCT item_id, unnest({split}) AS term FROM benchmark),
counted AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor({WEIGHT_SCALE} * ln(CAST(2 * n_documents + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, total GROUP BY term, n_documents),
scored AS (SELECT item_id, row, doc_id, CAST(sum(w * (({IMPACT_SCALE} * tf) // ({TF_SCALE} * tf + {LENGTH_SCALE} * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * n_documents) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN counted USING (term) JOIN weighed USING (term) JOIN sizes USING (row), total GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, row) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {params.k}"""
