"""Gradient-boosted regression over the feature store: one distributed fit for all items, or
per-item models for a caller-given list; early stopping, save, load and predict.

``fit_pooled`` trains one Spark ML ``Pipeline(VectorAssembler, GBTRegressor)`` over all items.  The
item enters as its mean label over its train rows, so there is no limit on the number of items and
an item without train rows has a defined input (the mean over all train rows).  Early stopping uses
the valid rows inside the same fit.  The number of Spark jobs depends on the trees, not on items.

``fit_item_models`` fits one model per item of a list the caller gives, with per-item settings
(``params_from_config``), for a menu of bounded size.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.timecols import calendar_columns

NOT_FEATURES = ("y_sales", "time_date", "dish_name", "dish_key", "split", "month_key")


@dataclass(frozen=True)
class BoostParams:
    """Boosting settings."""
    # The command-line defaults of the original trainer.
    n_estimators: int = 800
    max_depth: int = 7
    learning_rate: float = 0.03
    subsample: float = 0.9
    colsample_bytree: float = 0.9
    random_state: int = 42
    patience: int = 50  # early stopping: rounds without a better validation error
    # "patience": fit, score every round on the valid rows, refit with the best round count;
    # "tolerance": Spark's one-fit rule (stop when the validation error improves by less
    # than ``tolerance`` relative); "none": no early stopping.
    stopping: str = "patience"
    tolerance: float = 0.01


def params_from_config(config: dict[str, dict]) -> dict[str, BoostParams]:
    """Per-item settings from a ``{item_key: {n_estimators: .., ...}}`` mapping."""
    fields = set(BoostParams.__dataclass_fields__)
    return {k: BoostParams(**{f: v for f, v in p.items() if f in fields}) for k, p in config.items()}


def with_model_calendar(features: DataFrame, date_col: str = "time_date") -> DataFrame:
    """Month and day of year as model inputs."""
    return features.withColumns(calendar_columns(date_col))


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    numeric = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.DecimalType)
    return [f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, numeric)]


def _pipeline(cols: list[str], p: BoostParams, label: str, max_iter: int,
              validation_col: str | None = None) -> Pipeline:
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=p.max_depth,
                       stepSize=p.learning_rate, subsamplingRate=p.subsample,
                       featureSubsetStrategy=str(p.colsample_bytree), seed=p.random_state)
    if validation_col is not None:
        gbt = gbt.setValidationIndicatorCol(validation_col)
        gbt.set(gbt.validationTol, p.tolerance)
    return Pipeline(stages=[assembler, gbt])


def best_round(errors: list[float], patience: int) -> int:
    """Number of trees to keep: stop once ``patience`` rounds pass without a new minimum."""
    best, best_err = 0, float("inf")
    for i, e in enumerate(errors):
        if e < best_err:
            best, best_err = i, e
        elif i - best >= patience:
            break
    return best + 1


def fit_item(rows: DataFrame, cols: list[str], p: BoostParams, label: str = "y_sales") -> PipelineModel:
    """Fit on the ``train`` rows, with early stopping on the ``valid`` rows (``p.stopping``).

    ``patience`` keeps only the rounds up to the best validation error (refit with that many
    trees); ``tolerance`` is Spark's single-fit rule; ``none`` (or no valid rows) fits all
    ``n_estimators`` rounds."""
    train = rows.where(F.col("split") == "train")
    valid = rows.where(F.col("split") == "valid")
    if p.stopping == "none" or (p.stopping == "patience" and p.patience <= 0) or valid.isEmpty():
        return _pipeline(cols, p, label, p.n_estimators).fit(train)
    if p.stopping == "tolerance":
        both = rows.where(F.col("split").isin("train", "valid")).withColumn("_is_valid", F.col("split") == "valid")
        return _pipeline(cols, p, label, p.n_estimators, "_is_valid").fit(both)
    if p.stopping != "patience":
        raise ValueError(f"Unsupported stopping rule: {p.stopping}")
    model = _pipeline(cols, p, label, p.n_estimators).fit(train)
    errors = model.stages[-1].evaluateEachIteration(model.stages[0].transform(valid), "squared")
    keep = best_round(list(errors), p.patience)
    if keep >= p.n_estimators:
        return model
    return _pipeline(cols, replace(p, n_estimators=keep), label, keep).fit(train)


def fit_item_models(features: DataFrame, items: list[str], params: dict[str, BoostParams] | None = None,
                    default: BoostParams = BoostParams(), item_col: str = "dish_name",
                    label: str = "y_sales", max_parallel: int = 4) -> dict[str, PipelineModel]:
    """One model per item of ``items`` (the caller's own list, a bounded menu), fitted
    concurrently.  ``features`` must carry the ``split`` column (``chrono_split``).  Settings are
    looked up by item name, with spaces as given or as ``_``.  Items without train rows get no
    model and do not stop the others."""
    cols = feature_columns(features)
    params = params or {}

    def one(item: str) -> tuple[str, PipelineModel | None]:
        p = params.get(item, params.get(item.replace(" ", "_"), default))
        rows = features.where(F.col(item_col) == F.lit(item))
        return item, None if rows.where(F.col("split") == "train").isEmpty() else fit_item(rows, cols, p, label)

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return {item: model for item, model in pool.map(one, items) if model is not None}


def predict_items(features: DataFrame, models: dict[str, PipelineModel], item_col: str = "dish_name",
                  date_col: str = "time_date", name_col: str = "dish_name") -> DataFrame:
    """Score every row of every item that has a model; items without a model are skipped,
    as are models without rows.  Output: ``(time_date, dish_name, prediction)``.

    With ``item_col="dish_key"`` (the feature store's partition column) each item's rows
    are read from its own partition folder only."""
    parts = [model.transform(features.where(F.col(item_col) == F.lit(item)))
             .select(date_col, name_col, "prediction") for item, model in models.items()]
    if not parts:
        return features.sparkSession.createDataFrame([], f"{date_col} date, {name_col} string, prediction double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class PooledModel:
    """One model for all items: the fitted pipeline, the items' train means and the mean over all
    train rows, which stands in for items without train rows."""
    pipeline: PipelineModel
    means: DataFrame
    overall: float

    def save(self, root: str) -> None:
        self.pipeline.write().overwrite().save(f"{root}/pipeline")
        self.means.withColumn("overall", F.lit(self.overall)).write.mode("overwrite").parquet(f"{root}/means")

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> PooledModel:
        means = spark.read.parquet(f"{root}/means")
        overall = means.agg(F.max("overall")).head()[0]
        return cls(PipelineModel.load(f"{root}/pipeline"), means.drop("overall"), overall)


def _with_item_mean(features: DataFrame, means: DataFrame, overall: float, item_col: str) -> DataFrame:
    return (features.join(means, item_col, "left")
            .withColumn(ITEM_MEAN, F.coalesce(F.col(ITEM_MEAN), F.lit(float(overall)))))


ITEM_MEAN = "_item_mean"


def fit_pooled(features: DataFrame, p: BoostParams = BoostParams(stopping="tolerance", tolerance=0.0), item_col: str = "dish_name",
               label: str = "y_sales") -> PooledModel:
    """One distributed fit over the train rows of all items, stopping early on their valid rows.
    ``features`` should be materialised (it is read once per boosting round)."""
    cols = feature_columns(features) + [ITEM_MEAN]
    train = features.where(F.col("split") == "train")
    means = train.groupBy(item_col).agg(F.avg(F.col(label).cast("double")).alias(ITEM_MEAN))
    overall = train.agg(F.avg(F.col(label).cast("double"))).head()[0]
    if overall is None:
        raise ValueError("no train rows")
    rows = _with_item_mean(features.where(F.col("split").isin("train", "valid")), means, overall, item_col)
    return PooledModel(fit_item(rows, cols, p, label), means, float(overall))


def predict_pooled(features: DataFrame, model: PooledModel, item_col: str = "dish_name", date_col: str = "time_date",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``(time_date, dish_name, prediction)`` and the columns of ``keep`` for every row."""
    scored = model.pipeline.transform(_with_item_mean(features, model.means, model.overall, item_col))
    return scored.select(date_col, item_col, *keep, "prediction")
