"""Per-item model store: one Spark ML ``PipelineModel`` folder per item key."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from larder.functions.text import ITEM_KEY_PREFIX


def model_path(root: str, item: str) -> str:
    """The item's own folder: different names never share one."""
    return f"{root.rstrip('/')}/{ITEM_KEY_PREFIX}{quote(item, safe='')}"


def save_models(models: dict[str, PipelineModel], root: str) -> None:
    for item, model in models.items():
        model.write().overwrite().save(model_path(root, item))


def list_models(spark: SparkSession, root: str) -> list[str]:
    """The items that the store holds a model of, in order; none where there is no store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
    return sorted(unquote(n[len(ITEM_KEY_PREFIX):]) for n in names if n.startswith(ITEM_KEY_PREFIX))


def load_models(root: str, items: list[str]) -> dict[str, PipelineModel]:
    return {item: PipelineModel.load(model_path(root, item)) for item in items}
