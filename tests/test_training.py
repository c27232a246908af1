import datetime as dt
import random

from pyspark.sql import functions as F

from larder.operators import features as feat
from larder.operators import training
from larder.sources import models as model_store

D0 = dt.date(2024, 1, 1)
SMALL = training.BoostParams(n_estimators=4, max_depth=2, learning_rate=0.3, patience=2)


def series(spark, items=("pho bo", "bun cha"), days=30):
    rnd = random.Random(7)
    rows = [(item, D0 + dt.timedelta(days=d), rnd.randint(0, 20), float(rnd.random()), rnd.randint(0, 5))
            for item in items for d in range(days)]
    df = spark.createDataFrame(rows, "dish_name string, time_date date, y_sales long, x1 double, x2 long")
    return feat.chrono_split(training.with_model_calendar(df))


def test_best_round_patience():
    assert training.best_round([5, 4, 3, 3.5, 3.6, 3.7], patience=2) == 3
    assert training.best_round([5, 4, 3, 2, 1], patience=2) == 5
    assert training.best_round([1, 2, 3, 4], patience=2) == 1


def test_params_from_config():
    got = training.params_from_config({"pho_bo": {"n_estimators": 500, "max_depth": 4, "unknown": 1}})
    assert got["pho_bo"].n_estimators == 500 and got["pho_bo"].max_depth == 4
    assert got["pho_bo"].learning_rate == training.BoostParams().learning_rate


def test_feature_columns_exclude_target_and_keys(spark):
    cols = training.feature_columns(series(spark))
    assert cols == ["x1", "x2", "month", "day_of_year"]


def test_fit_predict_and_store(spark, tmp_path):
    df = series(spark)
    models = training.fit_item_models(df, ["pho bo", "bun cha"], default=SMALL, max_parallel=2)
    preds = training.predict_items(df, models)
    assert preds.count() == df.count()
    assert preds.where(F.col("prediction").isNull()).count() == 0
    model_store.save_models(models, str(tmp_path))
    back = model_store.load_models(str(tmp_path), ["pho bo"])
    again = training.predict_items(df, back)
    assert again.count() == 30
    # a model without rows contributes nothing; an item without a model is skipped
    only = training.predict_items(df.where(F.col("dish_name") == "bun cha"), back)
    assert only.count() == 0


def test_pooled_model_of_many_items_saved_and_loaded(spark, tmp_path):
    df = series(spark, items=tuple(f"item {i}" for i in range(40)), days=6)
    short = series(spark, items=("short",), days=1)  # one row: no train rows of its own
    both = df.unionByName(short)
    training.fit_pooled(both, training.BoostParams(n_estimators=3, max_depth=2, stopping="tolerance")).save(str(tmp_path / "m"))
    model = training.PooledModel.load(spark, str(tmp_path / "m"))
    out = training.predict_pooled(both, model)
    assert out.count() == both.count() and out.where("prediction is null").count() == 0


def test_item_without_train_rows_does_not_stop_the_others(spark):
    df = series(spark, items=("pho bo",), days=20).unionByName(series(spark, items=("a b",), days=1))
    assert set(training.fit_item_models(df, ["pho bo", "a b"], default=SMALL)) == {"pho bo"}


def test_model_folders_differ_by_name():
    names = ["a b", "a_b", "a/b", "..", "a%20b"]
    assert len({model_store.model_path("m", n) for n in names}) == len(names)


def test_tolerance_stopping_one_fit(spark):
    df = series(spark, items=("pho bo",))
    p = training.BoostParams(n_estimators=6, max_depth=2, learning_rate=0.3, stopping="tolerance")
    model = training.fit_item(df, training.feature_columns(df), p)
    assert model.stages[-1].getNumTrees <= 6
    assert model.transform(df).count() == 30
