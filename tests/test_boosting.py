"""Per-item boosted trees against a plain recursive fit, the patience rule and SQL over the trees."""

import datetime as dt
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import boosting as B
from larder.operators import features as feat
from larder.operators.training import BoostParams

D0 = dt.date(2024, 1, 1)
INPUTS = ["x1", "x2", "x3"]


def series(spark, items=("pho bo", "bun cha", "b/c=%"), days=60, seed=3):
    rnd = random.Random(seed)
    rows = []
    for k, item in enumerate(items):
        for d in range(days):
            x1, x2 = rnd.randint(0, 9), rnd.random()
            x3 = None if rnd.random() < 0.3 else float(rnd.randint(0, 3))
            rows.append((item, D0 + dt.timedelta(days=d), int(10 * k + 3 * x1 + (5 if x3 is None else x3) + 4 * (x2 > 0.4) + rnd.randint(0, 3)), x1, x2, x3))
    return feat.chrono_split(spark.createDataFrame(rows, "dish_name string, time_date date, y_sales long, x1 long, x2 double, x3 double"))


def plain_fit(x, y, p):
    """Sums of trees at the train rows, one recursive exact split search after another."""
    cuts = [sorted({(a + b) / 2 for a, b in zip(v, v[1:])}) + [math.inf] for v in (sorted({r[j] for r in x if r[j] is not None}) for j in range(len(INPUTS)))]
    predicted = [sum(y) / len(y)] * len(y)

    def value(rows, g):
        return -p.learning_rate * sum(g[i] for i in rows) / (len(rows) + 1)

    def grow(rows, g, depth, columns, out):
        total = sum(g[i] for i in rows)
        best = None
        if depth < p.max_depth:
            for j in columns:
                for cut in cuts[j]:
                    for missing_left in (False, True):
                        left = [i for i in rows if (missing_left if x[i][j] is None else x[i][j] < cut)]
                        if 0 < len(left) < len(rows):
                            a = sum(g[i] for i in left)
                            gain = a * a / (len(left) + 1) + (total - a) ** 2 / (len(rows) - len(left) + 1) - total * total / (len(rows) + 1)
                            if best is None or gain > best[0] + 1e-9 * max(1, abs(gain)):
                                best = gain, j, cut, missing_left
        if best is None or best[0] <= 1e-6:
            w = value(rows, g)
            return lambda r: w
        _, j, cut, missing_left = best
        goes = lambda r: missing_left if r[j] is None else r[j] < cut
        sides = [grow([i for i in rows if goes(x[i]) == s], g, depth + 1, columns, out) for s in (True, False)]
        return lambda r: sides[0](r) if goes(r) else sides[1](r)

    for t in range(p.n_estimators):
        g = [a - b for a, b in zip(predicted, y)]
        rows = np.flatnonzero(B._uniform(p.random_state, 2 * t, np.arange(len(y))) < p.subsample).tolist()
        keep = max(1, int(len(INPUTS) * p.colsample_bytree))
        columns = sorted(np.argsort(B._uniform(p.random_state, 2 * t + 1, np.arange(len(INPUTS))), kind="stable")[:keep].tolist())
        tree = grow(rows, g, 0, columns, None)
        predicted = [a + tree(r) for a, r in zip(predicted, x)]
    return predicted


@pytest.mark.parametrize("p", [BoostParams(n_estimators=6, max_depth=3, learning_rate=0.5, stopping="none"),
                               BoostParams(n_estimators=5, max_depth=7, learning_rate=0.3, subsample=0.6, colsample_bytree=0.7, random_state=5, stopping="none")])
def test_tree_sums_equal_a_plain_fit(spark, p):
    split = series(spark)
    models = B.fit_items(split, default=p, columns=INPUTS)
    train = split.where("split = 'train'").orderBy("time_date")
    scored = {(r["dish_name"], r["time_date"]): r["prediction"] for r in B.score_items(train, models.kept()).collect()}
    for item in ("pho bo", "bun cha", "b/c=%"):
        rows = train.where(F.col("dish_name") == item).collect()
        rows.sort(key=lambda r: r["time_date"])
        expected = plain_fit([[r[c] for c in INPUTS] for r in rows], [float(r["y_sales"]) for r in rows], p)
        assert np.allclose([scored[item, r["time_date"]] for r in rows], expected, atol=1e-8)


def test_items_stop_by_their_own_errors_and_keep_the_best_round(spark):
    p = BoostParams(n_estimators=60, max_depth=2, learning_rate=0.5, patience=4)
    models = B.fit_items(series(spark, items=tuple(f"item {i}" for i in range(6)), days=40), default=p, columns=INPUTS)
    errors = {}
    for r in models.rounds.orderBy("dish_name", "tree").collect():
        errors.setdefault(r["dish_name"], []).append(r["valid_rmse"])
    rule = {r["dish_name"]: r for r in B.patience_rule(models.rounds, p).collect()}
    trees = {r["dish_name"]: r["n"] for r in models.kept().where("tree >= 0").groupBy("dish_name").agg(F.count_distinct("tree").alias("n")).collect()}
    assert len({len(e) for e in errors.values()}) > 1
    for item, e in errors.items():
        best = e.index(min(e))
        due = next((t + 1 for t in range(len(e)) if t - min(range(t + 1), key=lambda i: (e[i], i)) >= p.patience), p.n_estimators)
        assert (rule[item]["ran"], rule[item]["best"], rule[item]["due"]) == (len(e), best, due) and due == len(e) and trees[item] == best + 1


def test_settings_by_item_and_odd_rows(spark):
    split = series(spark, items=("pho bo", "bun cha"), days=20)
    odd = split.limit(0).unionByName(split.where("dish_name = 'pho bo' AND split = 'test'").withColumn("dish_name", F.lit("only test")))
    odd = odd.unionByName(split.where("dish_name = 'pho bo' AND split = 'train'").limit(1).withColumn("dish_name", F.lit("one row")))
    odd = odd.unionByName(split.limit(3).withColumn("dish_name", F.lit(None).cast("string"))).unionByName(split.limit(3).withColumn("y_sales", F.lit(None).cast("long")))
    models = B.fit_items(split.unionByName(odd), {"pho_bo": BoostParams(n_estimators=3, stopping="none")}, BoostParams(n_estimators=2, stopping="none"), columns=INPUTS)
    ran = {r["dish_name"]: r["ran"] for r in B.best_rounds(models.rounds).collect()}
    assert ran == {"pho bo": 3, "bun cha": 2, "one row": 2}
    empty = B.fit_items(split.limit(0), columns=INPUTS)
    assert empty.rounds.collect() == [] and B.score_items(split, empty.kept()).collect() == []


def test_store_lists_replaces_and_prunes(spark, tmp_path):
    root = str(tmp_path / "models")
    split, p = series(spark), BoostParams(n_estimators=2, stopping="none")
    B.fit_items(split, default=p, columns=INPUTS).save(root)
    assert sorted(r[0] for r in B.listed_items(spark, root).collect()) == ["b/c=%", "bun cha", "pho bo"]
    B.fit_items(split.where("dish_name = 'pho bo'"), default=BoostParams(n_estimators=4, stopping="none"), columns=INPUTS).save(root)
    ran = {r["dish_name"]: r["ran"] for r in B.best_rounds(B.ItemModels.load(spark, root).rounds).collect()}
    assert ran == {"pho bo": 4, "bun cha": 2, "b/c=%": 2}
    some = B.ItemModels.load(spark, root, ["bun cha"]).kept()
    assert {r["dish_name"] for r in B.score_items(split, some).select("dish_name").distinct().collect()} == {"bun cha"}


def test_scores_equal_sql_over_the_tree_table(spark):
    split = series(spark)
    kept = B.fit_items(split, default=BoostParams(n_estimators=10, max_depth=4, learning_rate=0.3), columns=INPUTS).kept()
    con = duckdb.connect()
    con.register("trees", kept.toPandas())
    con.register("rows", split.select("dish_name", "time_date", *INPUTS).toPandas())
    sql = con.execute("""WITH RECURSIVE walk AS (
      SELECT r.dish_name, r.time_date, t.tree, 0 AS node FROM rows r JOIN (SELECT DISTINCT dish_name, tree FROM trees) t USING (dish_name)
      UNION ALL SELECT w.dish_name, w.time_date, w.tree, CASE WHEN CASE t.feature WHEN 'x1' THEN r.x1 WHEN 'x2' THEN r.x2 ELSE r.x3 END IS NULL
        OR isnan(CASE t.feature WHEN 'x1' THEN r.x1 WHEN 'x2' THEN r.x2 ELSE r.x3 END) THEN CASE WHEN t.missing_left THEN t."left" ELSE t."right" END
        WHEN CASE t.feature WHEN 'x1' THEN r.x1 WHEN 'x2' THEN r.x2 ELSE r.x3 END < t.cut THEN t."left" ELSE t."right" END
      FROM walk w JOIN trees t ON t.dish_name = w.dish_name AND t.tree = w.tree AND t.node = w.node AND t.feature IS NOT NULL
      JOIN rows r ON r.dish_name = w.dish_name AND r.time_date = w.time_date)
    SELECT dish_name, CAST(time_date AS DATE), SUM(value) FROM walk JOIN trees USING (dish_name, tree, node) WHERE feature IS NULL GROUP BY ALL""").fetchall()
    expected = {(a, b): c for a, b, c in sql}
    found = {(r["dish_name"], r["time_date"]): r["prediction"] for r in B.score_items(split, kept).collect()}
    assert found.keys() == expected.keys() and all(math.isclose(found[k], expected[k], abs_tol=1e-9) for k in found)
