"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "aerolith", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC time and no web interface.

    Cluster sizing (executors, memory, shuffle partitions) is left to spark-submit;
    pass it through ``conf`` in local runs (in a name without dots, underscores stand for them).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key if "." in key else key.replace("_", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="aerolith-"))
    return context.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Parquet at ``path`` with a declared schema, or None when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path)
    return [status.getPath().toString() for status in found or []]


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(filesystem.globStatus(hadoop_path))


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another may be, which is deleted."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (target, source))
    filesystem = old.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.delete(old, True)
    filesystem.mkdirs(old.getParent())
    if not filesystem.rename(new, old):
        raise OSError(f"could not move {source} to {target}")


def delete_path(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
