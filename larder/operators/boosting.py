"""Boosted trees for every item at once: one plan fits, stops and scores all items.

``fit_items`` brings the rows of an item together once and grows its trees level by level from
histograms over (node, feature, bin).  The group is bounded by the calendar, not by the data: the
feature store has one row per item and day, so an item with a third of all order lines has no more
rows than any other.  A boosting run is a chain of ``n_estimators`` x ``max_depth`` dependent steps; kept inside
one task per item they cost no Spark job each, and items run side by side.  Settings may differ by
item (``params_from_config``).

Trees and errors leave the tasks as tables, and everything after the fit is a query over them:

- ``ItemModels.rounds``: (item, tree, valid_rows, train_rmse, valid_rmse), one row for every round that ran;
- ``ItemModels.trees``: (item, tree, node, feature, cut, missing_left, left, right, value, rows); tree -1 is the
  start value, a leaf has no feature, and a row goes left if its feature is below ``cut``;
- ``best_rounds`` finds the round an item keeps and ``ItemModels.kept`` cuts its trees there, without a second fit;
- ``score_items`` joins rows and trees by item and walks all trees.

The rules are those of the usual second-order boosting with squared error: start at the mean of the
train labels, gain and leaf values with an L2 term of 1, at least one row a child, rows and columns
drawn per tree (by hash, so a repeated task draws the same), missing values on the better side, and
an item stops after ``patience`` rounds without a lower error on its valid rows.

Defined results: an item without train rows has no model; one without valid rows, or with
another stopping rule than ``patience``, runs all rounds and keeps all; a NULL label drops the row from the fit; NULL features count as missing; NULL items
are left out; repeated (item, day) rows all count."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions.text import ITEM_KEY_PREFIX, item_key
from larder.operators.training import BoostParams, feature_columns

#: L2 term of gains and leaves, least weight of a child, least gain of a split.
PENALTY, LEAST_ROWS, LEAST_GAIN = 1.0, 1.0, 1e-6
#: Bins of a feature's values within an item (one more for missing values).
MAX_BINS = 64

TREES = "tree int, node int, feature string, cut double, missing_left boolean, left int, right int, value double, rows long"
ROUNDS = "tree int, valid_rows long, train_rmse double, valid_rmse double"


def _uniform(seed: int, tree: int, at: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for every position, drawn by hashing (seed, tree, position)."""
    with np.errstate(over="ignore"):
        x = at.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53


def cuts_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Cuts between neighbouring distinct values, at most ``max_bins`` - 1 of them, evenly spread over the rows."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    if len(found) < 2:
        return np.zeros(0)
    cuts = (found[1:] + found[:-1]) / 2
    cuts = np.where(cuts > found[:-1], cuts, found[1:])  # neighbours too close for a value between
    if len(cuts) < max_bins:
        return cuts
    before = np.cumsum(counts)[:-1]
    wanted = np.arange(1, max_bins) * (counts.sum() / max_bins)
    return cuts[np.unique(np.minimum(np.searchsorted(before, wanted), len(cuts) - 1))]


@dataclass
class Tree:
    """Nodes as arrays, children behind parents; feature -1 marks a leaf, ``bin`` is the last bin on the left."""
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def leaves(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf of every row of ``bins``; the right child stands behind the left one."""
        node = np.zeros(len(bins), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            own = bins[inner, self.feature[at]]
            goes_left = np.where(own == missing, self.missing_left[at], own <= self.bin[at])
            node[inner] = self.left[at] + ~goes_left


def grow(bins: np.ndarray, gradient: np.ndarray, rows: np.ndarray, columns: np.ndarray, missing: int, p: BoostParams) -> Tree:
    """One tree over ``rows`` and ``columns``, level by level: a histogram over (node, feature, bin) gives every
    split of a level at once; the first best one wins, in order of feature and bin.  The last bin of a
    feature parts its present values from missing ones."""
    width, n_columns = missing + 1, len(columns)
    kinds = (("feature", int), ("bin", int), ("missing_left", bool), ("left", int), ("value", float), ("rows", int))
    made: dict[str, list] = {name: [] for name, _ in kinds}
    node = np.zeros(len(rows), np.int64)
    own, own_gradient = bins[np.ix_(rows, columns)].astype(np.int64), gradient[rows]
    offset = np.arange(n_columns) * width
    level, first, depth = 1, 0, 0
    while level:
        g = np.bincount(node, own_gradient, level)
        h = np.bincount(node, minlength=level).astype(float)
        chosen = np.full(level, -1)
        cut, to_left = np.zeros(level, int), np.zeros(level, bool)
        open_ = np.flatnonzero(h >= 2 * LEAST_ROWS)  # others have no split
        if depth < p.max_depth and n_columns and len(open_):
            place = np.full(level, -1)
            place[open_] = np.arange(len(open_))
            at = place[node]
            inside = at >= 0
            cells = (at[inside, None] * (n_columns * width) + offset + own[inside]).ravel()
            shape, size = (len(open_), n_columns, width), len(open_) * n_columns * width
            hist_g = np.bincount(cells, np.repeat(own_gradient[inside], n_columns), size).reshape(shape)
            hist_h = np.bincount(cells, minlength=size).reshape(shape)
            left_g, left_h = np.cumsum(hist_g[:, :, :missing], 2), np.cumsum(hist_h[:, :, :missing], 2)
            whole_g, whole_h = g[open_, None, None], h[open_, None, None]

            def gains(a, b):
                c, d = whole_g - a, whole_h - b
                return np.where((b >= LEAST_ROWS) & (d >= LEAST_ROWS), a * a / (b + PENALTY) + c * c / (d + PENALTY), -np.inf).reshape(len(open_), -1)

            found = gains(left_g, left_h)
            side = np.zeros(found.shape, bool)
            near = lambda v: 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(v), v, 0)))  # noqa: E731  rounding of sums
            if hist_h[:, :, missing].any():
                other = gains(left_g + hist_g[:, :, missing:], left_h + hist_h[:, :, missing:])
                side = other > found + near(found)
                found = np.where(side, other, found)
            # equal splits differ in their last bits by the order of sums; the first of them counts
            top = found.max(1)
            best = (found >= (top - near(top))[:, None]).argmax(1)
            rows_of = np.arange(len(open_))
            good = top - (g * g / (h + PENALTY))[open_] > LEAST_GAIN
            chosen[open_[good]] = columns[best[good] // missing]
            cut[open_], to_left[open_] = best % missing, side[rows_of, best]
        split = chosen >= 0
        child = first + level + 2 * (np.cumsum(split) - split)
        for name, values in (("feature", chosen), ("bin", cut), ("missing_left", to_left & split), ("left", np.where(split, child, -1)),
                             ("value", -p.learning_rate * g / (h + PENALTY)), ("rows", h)):
            made[name].append(values)
        inner = split[node]
        node, own, own_gradient, rows = node[inner], own[inner], own_gradient[inner], rows[inner]
        bin_of = bins[rows, chosen[node]]
        goes_left = np.where(bin_of == missing, to_left[node], bin_of <= cut[node])
        node = child[node] - (first + level) + ~goes_left
        first, level, depth = first + level, 2 * int(split.sum()), depth + 1
    return Tree(**{name: np.concatenate(made[name]).astype(kind) for name, kind in kinds})


def boost(x: np.ndarray, y: np.ndarray, valid_x: np.ndarray, valid_y: np.ndarray, p: BoostParams) -> Iterator[tuple]:
    """(start value, cuts of every feature), then (tree, train RMSE, valid RMSE) for every round that runs."""
    start = float(y.mean())
    cuts = [cuts_of(x[:, j], MAX_BINS) for j in range(x.shape[1])]
    yield start, cuts
    missing = max((len(c) + 1 for c in cuts), default=1)
    both = np.vstack([x, valid_x])
    bins = np.empty(both.shape, np.int16)
    for j, c in enumerate(cuts):
        bins[:, j] = np.where(np.isnan(both[:, j]), missing, np.searchsorted(c, both[:, j], side="right"))
    n, n_columns = len(y), x.shape[1]
    keep = max(1, int(n_columns * p.colsample_bytree)) if n_columns else 0
    predicted = np.full(len(both), start)
    best, best_error = 0, np.inf
    for t in range(p.n_estimators):
        rows = np.flatnonzero(_uniform(p.random_state, 2 * t, np.arange(n)) < p.subsample)
        columns = np.sort(np.argsort(_uniform(p.random_state, 2 * t + 1, np.arange(n_columns)), kind="stable")[:keep])
        tree = grow(bins, predicted[:n] - y, rows if len(rows) else np.arange(n), columns, missing, p)
        predicted += tree.value[tree.leaves(bins, missing)]
        error = float(np.sqrt(np.mean((predicted[n:] - valid_y) ** 2))) if len(valid_y) else None
        yield tree, float(np.sqrt(np.mean((predicted[:n] - y) ** 2))), error
        if error is None:
            continue
        if error < best_error:
            best, best_error = t, error
        elif t - best >= p.patience:
            return


def _setting(item: str, params: dict[str, BoostParams], default: BoostParams) -> BoostParams:
    return params.get(item, params.get(item.replace(" ", "_"), default))


@dataclass
class ItemModels:
    """The nodes of all trees of every item; the root of a tree carries the errors of its round."""
    nodes: DataFrame
    item_col: str = "dish_name"

    @property
    def trees(self) -> DataFrame:
        return self.nodes.select(self.item_col, *[c.split()[0] for c in TREES.split(", ")])

    @property
    def rounds(self) -> DataFrame:
        return self.nodes.where("valid_rows IS NOT NULL").select(self.item_col, *[c.split()[0] for c in ROUNDS.split(", ")])

    def kept(self) -> DataFrame:
        """The trees up to each item's best round."""
        last = best_rounds(self.rounds, self.item_col).select(self.item_col, "best")
        return self.trees.join(last, self.item_col).where(F.col("tree") <= F.col("best")).drop("best")

    def save(self, root: str) -> None:
        """One folder an item; a repeated save replaces the folders of the items it holds."""
        keyed = self.nodes.withColumn("dish_key", item_key(self.item_col))
        n = 4 * self.nodes.sparkSession.sparkContext.defaultParallelism
        (keyed.repartition(n, "dish_key").sortWithinPartitions("dish_key", "tree", "node").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("dish_key").parquet(root))

    @classmethod
    def load(cls, spark: SparkSession, root: str, items: list[str] | None = None, item_col: str = "dish_name") -> ItemModels:
        """All models that the store holds, or those of ``items`` (only their folders are read)."""
        nodes = spark.read.option("basePath", root).parquet(root)
        if items is not None:
            nodes = nodes.where(F.col("dish_key").cast("string").isin([ITEM_KEY_PREFIX + i for i in items]))
        return cls(nodes.drop("dish_key"), item_col)


def listed_items(spark: SparkSession, root: str) -> DataFrame:
    """``(dish_name)``: the items that have a model in the store, from its folder names."""
    keys = spark.read.option("basePath", root).parquet(root).select(F.col("dish_key").cast("string").alias("k")).distinct()
    return keys.select(F.substring("k", len(ITEM_KEY_PREFIX) + 1, 1 << 30).alias("dish_name"))


def best_rounds(rounds: DataFrame, item_col: str = "dish_name") -> DataFrame:
    """(item, ran, best): rounds that ran and the round with the lowest valid error, the first of equal
    ones; without valid rows the last round."""
    ran = F.max("tree") + 1
    return rounds.groupBy(item_col).agg(ran.alias("ran"), F.coalesce(F.min_by("tree", F.struct("valid_rmse", "tree")).alias("b"), ran - 1).alias("best"),
                                        F.max("valid_rows").alias("valid_rows")).withColumn(
        "best", F.when(F.col("valid_rows") > 0, F.col("best")).otherwise(F.col("ran") - 1)).select(item_col, "ran", "best")


def patience_rule(rounds: DataFrame, p: BoostParams, item_col: str = "dish_name") -> DataFrame:
    """(item, ran, best, due): beside what ran, the number of rounds that the patience rule allows by the
    errors: it ends with the first round that comes ``patience`` rounds after the lowest error so far."""
    by = Window.partitionBy(item_col).orderBy("tree")
    lowest = F.min("valid_rmse").over(by.rowsBetween(Window.unboundedPreceding, -1))
    better = F.when(lowest.isNull() | (F.col("valid_rmse") < lowest), F.col("tree"))
    since = F.col("tree") - F.max("better").over(by)
    told = rounds.withColumn("better", better).withColumn("since", since).groupBy(item_col).agg(
        F.min(F.when((F.col("valid_rows") > 0) & (F.col("since") >= p.patience), F.col("tree") + 1)).alias("due"))
    return best_rounds(rounds, item_col).join(told, item_col).withColumn("due", F.coalesce("due", F.lit(p.n_estimators)))


def fit_items(split: DataFrame, params: dict[str, BoostParams] | None = None, default: BoostParams = BoostParams(), item_col: str = "dish_name",
              label: str = "y_sales", date_col: str = "time_date", columns: list[str] | None = None, num_partitions: int | None = None) -> ItemModels:
    """Models of every item of ``split`` (features, label and ``split``: train, valid or test).  The result
    is lazy: save it and load it again, or each use fits anew.  ``params`` are settings by item name, as given or with ``_`` for spaces."""
    cols = feature_columns(split) if columns is None else list(columns)
    settings = dict(params or {})
    spark = split.sparkSession
    rows = split.where(F.col("split").isin("train", "valid") & F.col(label).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("_item"), F.col(date_col).alias("_day"), (F.col("split") == "train").alias("_train"), F.col(label).cast("double").alias("_y"),
        *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(cols)])

    def fit(table: pa.Table) -> pa.Table:
        item = table.column("_item")[0].as_py()
        table = table.sort_by([("_day", "ascending"), ("_y", "ascending"), *[(f"_x{j}", "ascending") for j in range(len(cols))]])
        y, train = table.column("_y").to_numpy(), table.column("_train").to_numpy()
        x = np.column_stack([table.column(f"_x{j}").to_numpy() for j in range(len(cols))]) if cols else np.zeros((len(y), 0))
        if not train.any():
            return SCHEMA.empty_table()
        p = _setting(item, settings, default)
        watched = ~train & (p.stopping == "patience" and p.patience > 0)  # valid rows count where they may stop the run
        n_valid = int(watched.sum())
        run = boost(x[train], y[train], x[watched], y[watched], p)
        start, cuts = next(run)
        parts = [pa.table({"tree": [-1], "node": [0], "value": [start], "rows": [int(train.sum())]})]
        for t, (tree, train_error, valid_error) in enumerate(run):
            n = len(tree.feature)
            leaf = tree.feature < 0
            root = np.arange(n) > 0  # what is told once a round stands on its root
            cut = [cuts[f][b] if f >= 0 and b < len(cuts[f]) else np.inf for f, b in zip(tree.feature.tolist(), tree.bin.tolist())]
            parts.append(pa.table({
                "tree": np.full(n, t, np.int32), "node": np.arange(n, dtype=np.int32), "value": tree.value, "rows": tree.rows,
                "feature": pa.array([None if f < 0 else cols[f] for f in tree.feature.tolist()], pa.string()), "cut": pa.array(cut, pa.float64(), mask=leaf),
                "missing_left": pa.array(tree.missing_left, mask=leaf), "left": pa.array(tree.left.astype(np.int32), mask=leaf),
                "right": pa.array((tree.left + 1).astype(np.int32), mask=leaf), "valid_rows": pa.array(np.full(n, n_valid), mask=root),
                "train_rmse": pa.array(np.full(n, train_error), mask=root),
                "valid_rmse": pa.array(np.full(n, 0.0 if valid_error is None else valid_error), mask=root | (valid_error is None))}))
        whole = pa.concat_tables(parts, promote_options="permissive")
        whole = whole.append_column("_item", pa.array([item] * whole.num_rows, pa.string()))
        return whole.select(SCHEMA.names).cast(SCHEMA)

    SCHEMA = pa.schema([("_item", pa.string()), ("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.string()), ("cut", pa.float64()),
                        ("missing_left", pa.bool_()), ("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64()), ("rows", pa.int64()),
                        ("valid_rows", pa.int64()), ("train_rmse", pa.float64()), ("valid_rmse", pa.float64())])
    # a fixed number of partitions: items are few and slow, and must not be merged by their size in bytes
    dealt = rows.repartition(num_partitions or 4 * spark.sparkContext.defaultParallelism, "_item")
    grown = dealt.groupBy("_item").applyInArrow(fit, f"_item string, {TREES}, valid_rows long, train_rmse double, valid_rmse double")
    grown = grown.withColumnRenamed("_item", item_col)
    return ItemModels(grown, item_col)


def score_items(rows: DataFrame, trees: DataFrame, item_col: str = "dish_name", keep: tuple[str, ...] = ("time_date",),
                num_partitions: int | None = None) -> DataFrame:
    """``item, *keep, prediction`` for every row of an item that has a model.  Rows of items without a model
    and models without rows give none.  ``trees`` as ``ItemModels.kept`` returns them."""
    used = sorted(r["feature"] for r in trees.where("feature IS NOT NULL").select("feature").distinct().collect())  # a subset of the table's columns
    spark = rows.sparkSession
    n = num_partitions or 4 * spark.sparkContext.defaultParallelism
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    left = rows.select(F.col(item_col).alias("_item"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                       *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(used)])
    right = trees.withColumnRenamed(item_col, "_item")
    place = {name: j for j, name in enumerate(used)}

    def walk(table: pa.Table, grown: pa.Table) -> pa.Table:
        ids = [table.column("_item"), *[table.column(f"_k{i}") for i in range(len(keep))]]
        names = ["_item", *[f"_k{i}" for i in range(len(keep))]]
        if not grown.num_rows or not table.num_rows:
            return pa.table([*[c.slice(0, 0) for c in ids], pa.array([], pa.float64())], [*names, "prediction"])
        x = np.column_stack([table.column(f"_x{j}").to_numpy() for j in range(len(used))]) if used else np.zeros((table.num_rows, 0))
        grown = grown.sort_by([("tree", "ascending"), ("node", "ascending")])
        tree = grown.column("tree").to_numpy()
        feature = np.array([place.get(f, -1) for f in grown.column("feature").to_pylist()], np.int64)
        cut, value = grown.column("cut").to_numpy(), grown.column("value").to_numpy()
        to_left = np.array([bool(b) for b in grown.column("missing_left").to_pylist()])
        left, right = (np.array([c or 0 for c in grown.column(side).to_pylist()], np.int64) for side in ("left", "right"))
        total = np.zeros(len(x))
        for first in np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]):
            node = np.full(len(x), first)
            while True:
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                own = x[inner, feature[at]]
                goes_left = np.where(np.isnan(own), to_left[at], own < cut[at])
                node[inner] = first + np.where(goes_left, left[at], right[at])
            total += value[node]
        return pa.table([*ids, pa.array(total)], [*names, "prediction"])

    schema = ", ".join([f"_item {kinds[item_col]}", *[f"_k{i} {kinds[c]}" for i, c in enumerate(keep)], "prediction double"])
    both = left.repartition(n, "_item").groupBy("_item").cogroup(right.repartition(n, "_item").groupBy("_item"))
    return both.applyInArrow(walk, schema).toDF(item_col, *keep, "prediction")
