"""Session helpers: defaults that suit a shared cluster and local tests alike."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only when the cluster did not set them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "larder") -> SparkSession:
    """Return the active session, or build one with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a cluster leave
    them unset so that the cluster's own settings win.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Whoever runs a cluster job must set it (to distributed storage); without it a cluster
    session is refused, because executors would write to their own disks.  Only for a local
    master, as in tests, a temporary folder is made where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="larder-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, deleted when Python exits (a
    lazy result may read it until then)."""
    path = f"{checkpoint_dir(spark)}/larder/{name}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


_EXPR_CACHE: dict[tuple, object] = {}


def cached(key: tuple, build):
    """Memoise Column expressions per application.

    Building a Column is one Py4J round trip per operation; plans with dozens of window
    expressions spend more time there than executing on small inputs.  Columns are immutable and
    hold no data, so reusing them is safe; scans are never kept."""
    active = SparkSession.getActiveSession()
    full_key = (active.sparkContext.applicationId if active is not None else None, *key)
    if full_key not in _EXPR_CACHE:
        _EXPR_CACHE[full_key] = build()
    return _EXPR_CACHE[full_key]
