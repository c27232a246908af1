"""Mixing sources to target weights by hierarchical budgeting.

The token budget flows down a tree (domain, language, source).  Every node's capacity is what its
subtree can give within ``max_epochs`` passes.  A parent's budget is shared among its children in
proportion to their weights; a child that cannot use its share gives the shortage to its siblings
first, and because no node is ever given more than its subtree holds, only what a whole family
lacks reaches the family's own siblings, then theirs, and so on up.  Each leaf then takes whole
passes over its documents and, from one more seeded pass, the longest prefix of documents within
the tokens that remain.

Everything is DataFrame code: the tree has one row per node, and running token sums are taken in
two levels (4096 hash buckets of a leaf, then inside a bucket), so a leaf with a third of all rows
is spread over as many tasks as it has buckets.

Defined results
    NULL in a level column: a value of its own, the empty string.  NULL or empty text: no tokens;
    such documents cost nothing and come with every prefix.  NULL doc_id: hashed as empty text.
    Repeated rows: each is a document.  Ties in the seeded order: by doc_id, then tokens.
    Weights are positive integers; a value without one weighs 1.  Empty table: empty result.
    Further columns pass through ``select_documents`` unchanged; internal names start with _mix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import common as C

WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}})
    #: Tokens wanted; None: as many as the documents have.
    budget: int | None = None
    max_epochs: int = 2
    seed: int = 17


#: Domains of the query and of the pipeline, by the number that ends a source's name, modulo 3.
DOMAINS = ("web", "books", "code")


def domain_of(source: str = "source") -> Column:
    """The domain of a source: by the number at the end of its name, or the first domain."""
    number = F.coalesce(F.try_to_number(F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1), F.lit("999999999")).cast("long"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (F.pmod(number, F.lit(len(DOMAINS))) + 1).cast("int"))


def n_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def weight_of(level: str, params: MixParams) -> Column:
    out = F.lit(1)
    for value, weight in params.weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(weight)).otherwise(out)
    return out.cast("long")


def wide(column: str) -> Column:
    """Whole numbers whose products do not overflow: tokens of a source times weights."""
    return F.col(column).cast("decimal(19,0)")


def share_out(children: DataFrame, parent: list[str], order: str, budget: str) -> DataFrame:
    """Give each parent's ``budget`` to its children (columns ``weight``, ``cap``): in proportion
    to weight, no child above its cap, exact whole tokens.  Adds ``given``."""
    by = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("weight")), order)
    before, onwards = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    family = Window.partitionBy(*parent)
    zero = F.lit(0).cast("long")
    filled = (children
              .withColumn("_caps", F.coalesce(F.sum("cap").over(before), zero))
              .withColumn("_weights", F.sum("weight").over(onwards))
              # a child is full when even an equal split of the rest would exceed its cap
              .withColumn("_full", wide("cap") * wide("_weights") <= wide("weight") * (wide(budget) - wide("_caps")))
              .withColumn("_rest", F.col(budget) - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(zero)).over(family))
              .withColumn("_open", F.when(F.col("_full"), zero).otherwise(F.col("weight"))))
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    filled = filled.withColumn("_all", F.sum("_open").over(family)).withColumn("_upto", F.sum("_open").over(upto))
    part = lambda w: F.expr(f"cast(cast(_rest as decimal(19,0)) * cast({w} as decimal(19,0)) div greatest(_all, 1) as long)")
    return (filled.withColumn("given", F.when(F.col("_full"), F.col("cap")).otherwise(part("_upto") - part("_upto - _open")))
            .drop("_caps", "_weights", "_full", "_rest", "_open", "_all", "_upto"))


def leaf_budgets(leaves: DataFrame, params: MixParams) -> DataFrame:
    """``leaves`` (level columns, tokens) plus ``given``: the tokens each leaf is to yield."""
    levels = list(params.levels)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    wanted = F.col("all") if params.budget is None else F.lit(params.budget).cast("long")
    nodes = total.select(F.least(wanted, F.col("all") * params.max_epochs).alias("given"))
    for depth, level in enumerate(levels, 1):
        path, above = levels[:depth], levels[:depth - 1]
        children = leaves.groupBy(*path).agg((F.sum("tokens") * params.max_epochs).alias("cap"))
        children = children.withColumn("weight", weight_of(level, params))
        upper = nodes.select(*above, F.col("given").alias("budget"))
        # the root is one row; below it, parents meet their children by path
        children = children.join(upper, above) if above else children.join(upper, F.lit(True))
        nodes = share_out(children, above, level, "budget").select(*path, "given")
    return leaves.join(nodes, levels)


def plan(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(doc_id, level columns, n_tokens) -> the same and ``copies``, the passes that contain the
    document.  The columns must be exactly these; see ``select_documents`` for any others."""
    levels = list(params.levels)
    leaves = docs.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    leaves = leaf_budgets(leaves, params).select(
        *levels, F.expr("given div greatest(tokens, 1)").alias("passes"), F.expr("given % greatest(tokens, 1)").alias("rest"))
    # the passes of a leaf seed its last order, so they join before the hash
    key = F.md5(F.concat_ws("|", F.lit(params.seed), F.col("passes"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = docs.join(leaves, levels).withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, 3))
    # salted sums first: a bucket of a hot leaf is small, a leaf is not
    sums = keyed.groupBy(*levels, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    earlier = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(*levels, "_bucket", (F.sum("_sum").over(earlier) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy(*levels, "_bucket").orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.join(sums, [*levels, "_bucket"]).withColumn("_upto", F.col("_before") + F.sum("n_tokens").over(inside))
    copies = F.col("passes") + (F.col("_upto") <= F.col("rest")).cast("long")
    return placed.select("doc_id", *levels, "n_tokens", copies.alias("copies"))


def level_columns(docs: DataFrame, params: MixParams) -> list[Column]:
    """The level columns with NULL as the empty string; a missing ``domain`` follows the source."""
    out = []
    for level in params.levels:
        if level in docs.columns:
            out.append(F.coalesce(F.col(level).cast("string"), F.lit("")).alias(level))
        elif level == "domain":
            out.append(domain_of().alias(level))
        else:
            raise ValueError(f"no column {level}")
    return out


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """How often each document (doc_id, text, level columns) is taken: one row per document."""
    scratch = C.Scratch(docs.sparkSession, "mixing")
    sized = scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *level_columns(docs, params), n_tokens().alias("n_tokens")), "sized")
    return plan(sized, params)


def select_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (rows it does not take are absent)."""
    taken = (mix(docs, params).groupBy(F.col("doc_id").alias("_mix_id"), F.col("n_tokens").alias("_mix_tokens"),
                                                            *[F.col(c).alias(f"_mix_{i}") for i, c in enumerate(params.levels)])
             .agg(F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_rows")).where("_mix_copies > 0"))
    own = docs.select("*", n_tokens().alias("_mix_n"), *[c.alias(f"_mix_own_{i}") for i, c in enumerate(level_columns(docs, params))])
    match = own["doc_id"].cast("long").eqNullSafe(taken["_mix_id"]) & (own["_mix_n"] == taken["_mix_tokens"])
    for i in range(len(params.levels)):
        match = match & (own[f"_mix_own_{i}"] == taken[f"_mix_{i}"])
    # rows that are alike in id, leaf and length share their copies
    alike = Window.partitionBy("_mix_id", "_mix_n", *[f"_mix_{i}" for i in range(len(params.levels))]).orderBy(F.xxhash64("text"))
    joined = own.join(taken, match).withColumn("_mix_rank", F.when(F.col("_mix_rows") == 1, F.lit(1)).otherwise(F.row_number().over(alike)))
    times = F.expr("_mix_copies div _mix_rows + cast(_mix_rank <= _mix_copies % _mix_rows as int)")
    return (joined.withColumn("_mix_times", times).where("_mix_times > 0")
            .withColumn("_mix_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_times").cast("long")))).select(*docs.columns))


def sql(params: MixParams = MixParams()) -> str:
    """DuckDB SQL for ``mix`` over ``documents`` with the derived domain."""
    case = lambda level: (f"CASE {level} " + " ".join(f"WHEN '{v}' THEN {w}" for v, w in params.weights.get(level, {}).items())
                          + " ELSE 1 END") if params.weights.get(level) else "1"
    domains = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DOMAINS))
    own = {"domain": f"CASE coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT), 0) % {len(DOMAINS)} {domains} END"}
    picks = ", ".join(f"{own.get(c, f'''coalesce(CAST({c} AS VARCHAR), '')''')} AS {c}" for c in params.levels)
    budget = "sum(n_tokens)" if params.budget is None else str(params.budget)
    parts = [f"""WITH sized AS (SELECT doc_id, {picks},
  CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0b\\x0c\\r]+')), 0) AS BIGINT) AS n_tokens FROM documents),
n0 AS (SELECT least(CAST(coalesce({budget}, 0) AS BIGINT), CAST(coalesce(sum(n_tokens), 0) AS BIGINT) * {params.max_epochs}) AS given FROM sized)"""]
    for depth, level in enumerate(params.levels, 1):
        path, above = ", ".join(params.levels[:depth]), ", ".join(params.levels[:depth - 1])
        join = f"JOIN n{depth - 1} USING ({above})" if above else "CROSS JOIN n0"
        part = f"PARTITION BY {above}" if above else ""
        order = f"ORDER BY CAST(cap AS DOUBLE) / weight, {level}"
        parts.append(f"""c{depth} AS (SELECT {path}, CAST(sum(n_tokens) AS BIGINT) * {params.max_epochs} AS cap, {case(level)} AS weight FROM sized GROUP BY {path}),
f{depth} AS (SELECT {path}, cap, weight, given AS budget,
  coalesce(sum(cap) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
  sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM c{depth} {join}),
g{depth} AS (SELECT *, cap * weights <= weight * (budget - caps) AS is_full FROM f{depth}),
h{depth} AS (SELECT *, budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part}) AS rest,
  CASE WHEN is_full THEN 0 ELSE weight END AS room FROM g{depth}),
i{depth} AS (SELECT *, sum(room) OVER ({part}) AS rooms, sum(room) OVER ({part} {order} ROWS UNBOUNDED PRECEDING) AS upto FROM h{depth}),
n{depth} AS (SELECT {path}, CASE WHEN is_full THEN cap ELSE rest * upto // greatest(rooms, 1) - rest * (upto - room) // greatest(rooms, 1) END AS given FROM i{depth})""")
    path = ", ".join(params.levels)
    parts.append(f"""leaves AS (SELECT {path}, given // greatest(sum(n_tokens), 1) AS passes, given % greatest(sum(n_tokens), 1) AS rest
  FROM sized JOIN n{len(params.levels)} USING ({path}) GROUP BY {path}, given),
keyed AS (SELECT *, md5(concat_ws('|', {params.seed}, passes, coalesce(CAST(doc_id AS VARCHAR), ''))) AS k FROM sized JOIN leaves USING ({path})),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {path} ORDER BY k, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM keyed)
SELECT doc_id, {path}, n_tokens, CAST(passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM placed""")
    return ",\n".join(parts)
