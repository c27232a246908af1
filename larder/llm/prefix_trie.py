"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn is named by 96 bits of its role and text, followed by its number of words, so a name tells
what a node needs to know about its last turn.  A conversation becomes rows of ``width`` turn-id
columns, one row for each block of turns, keyed by the node its earlier blocks end in.  One
``GROUP BY ROLLUP`` over these columns, with ``grouping_id`` for the depth, then aggregates every prefix
of every block of every conversation at once: no rounds over depths or blocks.

What a node sums over its subtree is rolled up in the same way.  Every node belongs to one
conversation, its smallest member; the nodes of a conversation are a suffix of its path.  So the
words of the distinct nodes below a node are the words that its members own, and a second ROLLUP
over (words owned, leaf owned) gives them without walking the tree.

Long and hot conversations.  Turns are numbered by two-level counts: rows are range-partitioned by
(conversation, turn), numbered inside a partition, and shifted by the counts of the partitions
before; a conversation with a third of all rows is spread over as many partitions as its rows take.  Of
its blocks only 16 bytes each meet in one task, which chains their keys as a stream.  Hot prefixes
are pre-aggregated by ROLLUP's partial sums.  The ids that end in a node are hashed as a sorted stream,
since their digest is sequential.

Defined results
    NULL role or text: empty.  NULL turn: before the others.  Turns alike in number: in the order of
    their names (digests); repeated rows are turns of their own.  NULL conv_id: left out, it has no
    decimal form.  Empty table: no rows.  Further columns are ignored."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import common as C


@dataclass(frozen=True)
class TrieParams:
    #: Turn-id columns of a block.
    width: int = 8


#: Fixed by the query's contract: a conversation starts with the first turns of the one at the start of
#: its family, as many as crc32 of its number leaves.
FAMILY, HEADS = 20, 4

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn's name, of the number of words behind it, and of a node's key.
TURN_BYTES, WORD_BYTES, KEY_BYTES = 12, 4, 16
ROOT = "X'" + "00" * KEY_BYTES + "'"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_names(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t): 96 bits of role and text, then the words of the text; no text goes further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    name = F.substring(F.sha2(whole, 256), 1, 2 * TURN_BYTES)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 2 * WORD_BYTES, "0")
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                             F.unhex(F.concat(name, words)).alias("t"))


def words_of(turn: str | Column) -> Column:
    return F.conv(F.hex(F.substring(turn, TURN_BYTES + 1, WORD_BYTES)), 16, 10).cast("long")


def number_turns(turns: DataFrame, scratch: C.Scratch) -> DataFrame:
    """``turns`` (conv_id, turn, t) with ``pos``, from 1 in the order of turn (NULL first), then t."""
    ordered = (turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "t")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "t").withColumn("part", F.spark_partition_id()))

    def number(batches):
        now, met = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            at = np.arange(len(ids)) - np.repeat(heads, np.diff(np.r_[heads, len(ids)])) + 1
            if now == ids[0]:
                at[:heads[1] if len(heads) > 1 else len(ids)] += met
            now, met = ids[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.int64()), batch.column(2)], ["conv_id", "t", "at", "part"])

    # written once: a repeated task must not meet other borders
    kept = scratch.keep(ordered.select("conv_id", "t", "part").mapInArrow(number, "conv_id long, t binary, at long, part int"), "numbered")
    counts = kept.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("before", F.sum("n").over(earlier)).where("before IS NOT NULL").select("conv_id", "part", "before")
    # at most one conversation of a partition began in an earlier one: one row a partition at most
    return (kept.join(F.broadcast(shifts), ["conv_id", "part"], "left")
            .select("conv_id", "t", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos")))


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n turns, words) of every rebuilt conversation, turnless ones too, and (conv_id, pos, t) of
    its turns: the first h of its family's first conversation, then its own behind its first h."""
    base = F.expr(f"conv_id - conv_id % {FAMILY}")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = numbered.withColumn("h", h)
    counts = numbered.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(words_of("t")).alias("words"))
    convs = counts.select("conv_id", base.alias("base"), h.alias("h"))
    heads = numbered.where(F.col("pos") < HEADS).where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), "pos", "t")
    borrowed = convs.join(heads, "base").where("pos <= h").select("conv_id", "pos", "t")
    # conversations that got fewer than h turns; their own move up
    lent = borrowed.groupBy("conv_id").agg(F.count("*").alias("got"))
    short = (convs.where("h > 0").join(lent, "conv_id", "left")
             .select("conv_id", (F.col("h") - F.coalesce("got", F.lit(0))).alias("missing")).where("missing > 0"))
    kept = own.where("pos > h").join(short, "conv_id", "left").select("conv_id", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("pos"), "t")
    turns = borrowed.unionByName(kept)
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(words_of("t")).alias("words"))
    zero = F.lit(0).cast("long")
    return convs.select("conv_id").join(sizes, "conv_id", "left").select("conv_id", F.coalesce("n", zero).alias("n"), F.coalesce("words", zero).alias("words")), turns


def _key(prior: Column, body: Column) -> Column:
    """Name of the node that the turns ``body`` lead to from the node ``prior``."""
    return F.unhex(F.substring(F.sha2(F.concat(prior, F.unhex(F.sha2(body, 256))), 256), 1, 2 * KEY_BYTES))


def blocks(convs: DataFrame, turns: DataFrame, scratch: C.Scratch, width: int) -> DataFrame:
    """One row a block: conv_id, n, words (of the whole conversation), block (from 0), prior (node its
    earlier turns end in), before (words up to there) and the turn-id columns t1..t{width}."""
    names = [f"t{i + 1}" for i in range(width)]
    slot = (F.col("pos") - 1) % width
    cut = turns.groupBy("conv_id", ((F.col("pos") - 1) / width).cast("long").alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("t"))).alias(name) for i, name in enumerate(names)])
    cut = scratch.keep(cut.join(convs.where("n > 0"), "conv_id"), "blocks")
    row = cut.select("conv_id", "n", "words", "block", *names)
    short = row.where(F.col("n") <= width).withColumn("prior", F.expr(ROOT)).withColumn("before", F.lit(0).cast("long"))
    long = row.where(F.col("n") > width)
    body = F.concat_ws("", *[F.hex(t) for t in names])
    said = sum((F.coalesce(words_of(t), F.lit(0)) for t in names), F.lit(0)).cast("long")
    links = (long.select("conv_id", "block", F.unhex(F.sha2(F.unhex(body), 256)).alias("body"), said.alias("said"))
             .repartition("conv_id").sortWithinPartitions("conv_id", "block"))

    def chain(batches):
        now = prior = None
        before = 0
        for batch in batches:
            priors, befores = [], []
            for conv_id, body, said in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if conv_id != now:
                    now, prior, before = conv_id, bytes(KEY_BYTES), 0
                priors.append(prior)
                befores.append(before)
                prior, before = hashlib.sha256(prior + body).digest()[:KEY_BYTES], before + said
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(priors, pa.binary()), pa.array(befores, pa.int64())],
                                             ["conv_id", "block", "prior", "before"])

    chained = links.mapInArrow(chain, "conv_id long, block long, prior binary, before long")
    return short.unionByName(long.join(chained, ["conv_id", "block"]))


def roll_up(rows: DataFrame, width: int, **measures: str) -> DataFrame:
    """ROLLUP over the turn-id columns of each block: a row for every node but the root, with
    ``key``, ``parent``, ``depth``, ``w`` (words of its last turn), ``path`` (words up to and with it) and the
    aggregated ``measures`` (SQL by name)."""
    names = [f"t{i + 1}" for i in range(width)]
    listed, sums = ", ".join(names), ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    out = rows.sparkSession.sql(f"""SELECT block, prior, {listed}, grouping_id() AS gid, max(before) AS before, {sums}
        FROM {{rows}} GROUP BY block, prior, ROLLUP({listed})""", rows=rows)
    # grouping_id has a set bit for every column that is rolled away; with all of them away the row
    # stands for the node before the block, which the block before has already
    out = out.withColumn("level", F.lit(width) - F.bit_count("gid")).where("level > 0")
    # a level behind the end of a conversation repeats its last one
    out = out.where(F.element_at(F.array(*names), F.col("level")).isNotNull())
    shown = F.concat_ws("", *[F.hex(t) for t in names])  # columns rolled away are NULL
    parent_shown = F.substring(shown, F.lit(1), (F.col("level") - 1) * 2 * (TURN_BYTES + WORD_BYTES))
    said = sum((F.coalesce(words_of(t), F.lit(0)) for t in names), F.lit(0))
    return out.select(
        _key(F.col("prior"), F.unhex(shown)).alias("key"),
        F.when(F.col("level") == 1, F.col("prior")).otherwise(_key(F.col("prior"), F.unhex(parent_shown))).alias("parent"),
        (F.col("block") * width + F.col("level")).alias("depth"), words_of(F.element_at(F.array(*names), F.col("level"))).alias("w"),
        (F.col("before") + said).cast("long").alias("path"), *measures)


def ends_digests(rows: DataFrame, convs: DataFrame, width: int) -> DataFrame:
    """(key, ends_sha256) of the nodes in which a conversation ends; turnless ones end in the root."""
    names = [f"t{i + 1}" for i in range(width)]
    last = rows.where((F.col("block") + 1) * width >= F.col("n"))
    ends = (last.select(_key(F.col("prior"), F.unhex(F.concat_ws("", *[F.hex(t) for t in names]))).alias("key"), "conv_id")
            .unionByName(convs.where("n = 0").select(F.expr(ROOT).alias("key"), "conv_id")))

    def digest(batches):
        now = state = None
        out = []

        def batch_of():
            batch = pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], ["key", "ends_sha256"])
            out.clear()
            return batch

        for batch in batches:
            for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(b"%d" % conv_id)
                else:
                    state.update(b",%d" % conv_id)
            if len(out) >= 10_000:
                yield batch_of()
        if state is not None:
            out.append((now, state.hexdigest()))
            yield batch_of()

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, params: TrieParams = TrieParams()) -> DataFrame:
    """A row for every node of the trie of the rebuilt conversations, the root first in depth."""
    scratch = C.Scratch(conversations.sparkSession, "trie")
    width = params.width
    # kept, because finding the borders of a range partitioning reads its input once more
    named = scratch.keep(turn_names(conversations.select("conv_id", "turn", "role", "text")), "named")
    numbered = number_turns(named, scratch)
    convs, turns = rebuilt(numbered)
    convs = scratch.keep(convs, "convs")
    rows = scratch.keep(blocks(convs, turns, scratch, width), "rows")
    scratch.drop("named", "numbered", "blocks")
    nodes = scratch.keep(roll_up(rows, width, conv_id="min(conv_id)", longest="max(n)"), "nodes")
    # what each conversation owns: the nodes whose smallest member it is
    owned = nodes.groupBy("conv_id").agg(F.sum("w").alias("own_words"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("own_leaf"))
    zero = F.lit(0).cast("long")
    weighed = rows.join(owned, "conv_id", "left").withColumns({c: F.coalesce(c, zero) for c in ("own_words", "own_leaf")})
    totals = roll_up(weighed, width, conv_id="min(conv_id)", n_convs="count(*)", said="sum(words)", own="sum(own_words)", n_leaves="sum(own_leaf)")
    # the smallest member's own numbers come by a join: a struct in the ROLLUP would be sorted, not hashed
    totals = totals.join(convs.where("n > 0").join(owned, "conv_id").select("conv_id", "own_words", "words"), "conv_id")
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    ends = ends_digests(rows, convs, width)
    # members' words at and below the node, less the words of the distinct nodes there; of its smallest
    # member's own nodes only those at and below it count
    above = F.col("path") - F.col("w")
    saved = (F.col("said") - F.col("n_convs") * above) - (F.col("own") - F.col("own_words") + F.col("words") - above)
    # a node's parent lies on its smallest member's path: the parent's own smallest member is looked up, but the
    # root's, which may be the parent of a third of all nodes, is one value
    whole = convs.join(owned, "conv_id", "left").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("words").alias("said"), F.coalesce(F.sum("own_words"), zero).alias("own"),
        F.coalesce(F.sum("own_leaf"), zero).alias("n_leaves")).where("n_convs > 0")
    top = whole.select(F.lit(0).cast("long").alias("depth"), F.expr(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), "conv_id", "n_convs",
                       F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), (F.col("said") - F.col("own")).alias("saved_tokens"))
    below = totals.select("depth", "key", "parent", "conv_id", "n_convs", "n_leaves", saved.cast("long").alias("saved_tokens"))
    every = below.unionByName(top)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    first = whole.select(F.expr(ROOT).alias("parent"), F.col("conv_id").alias("parent_conv_id"))  # one row
    deep = every.where("depth > 1").join(parents, "parent", "left").withColumnRenamed("above", "parent_conv_id")
    shallow = every.where("depth <= 1").join(F.broadcast(first), "parent", "left")
    out = deep.unionByName(shallow).join(children, "key", "left").join(ends, "key", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def sql() -> str:
    """DuckDB SQL for ``prefix_trie`` over ``conversations``: every prefix of every conversation is listed."""
    byte = "xor(c // 2, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)"
    crc = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
           f"lambda a, b: list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: {byte})), 4294967295)")
    return f"""WITH named AS (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+')) AS w,
  substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, {2 * TURN_BYTES}) AS t FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT conv_id, t, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t) AS pos FROM named),
convs AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {crc} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM numbered)),
turns AS (SELECT c.conv_id, 0 AS own, n.pos, n.t, n.w FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, n.pos, n.t, n.w FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.h),
paths AS (SELECT conv_id, list(t ORDER BY own, pos) AS path, list(w ORDER BY own, pos) AS words FROM turns GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(path, []) AS path, coalesce(words, []) AS words FROM convs LEFT JOIN paths USING (conv_id)),
steps AS (SELECT conv_id, path, words, unnest(range(0, len(path) + 1)) AS depth FROM whole),
nodes AS (SELECT path[:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(len(path)) AS longest, max(coalesce(words[depth], 0)) AS w,
  coalesce(string_agg(CASE WHEN len(path) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM steps GROUP BY ALL),
above AS (SELECT key[:e] AS key, depth, longest, n_convs, w FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM nodes)),
below AS (SELECT key, sum(CASE WHEN longest = depth THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * w) AS saved FROM above GROUP BY key),
children AS (SELECT key[:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[:n.depth - 1]"""
