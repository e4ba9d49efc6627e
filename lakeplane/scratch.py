"""Intermediate results in the folder all executors share.

Iterative operators cut their lineage here. A written table survives the loss of executors, gives the next plan true
sizes, and lets Catalyst prune its columns; cached blocks or local checkpoints do none of these.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_WRITTEN: dict[str, set[str]] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode, where all tasks see it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: iterative operators need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="lakeplane-")
    return "file://" + _OWN[app]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it isn't there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted at the end of the session."""
    app = spark.sparkContext.applicationId
    if app not in _WRITTEN:
        _WRITTEN[app] = set()
        atexit.register(_clean, spark, app)
    path = f"{folder(spark)}/lakeplane/{app}/{name}-{uuid.uuid4().hex}"
    _WRITTEN[app].add(path)
    return path


def cut(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables made by ``cut`` that no later plan reads."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            spark = df.sparkSession
            _WRITTEN.get(spark.sparkContext.applicationId, set()).discard(path)
            _delete(spark, path)


def stored_bytes(df: DataFrame) -> int:
    """Size on disk of a table made by ``cut``."""
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _clean(spark: SparkSession, app: str) -> None:
    for path in _WRITTEN.pop(app, set()):
        try:
            _delete(spark, path)
        except Exception:  # the JVM may be gone; the folder's owner removes the rest
            return
