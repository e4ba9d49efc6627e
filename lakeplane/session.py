"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What results depend on; everything else (memory, partitions) is the cluster's to choose.
REQUIRED = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}


def builder(app: str = "lakeplane") -> SparkSession.Builder:
    out = SparkSession.builder.appName(app)
    for key, value in REQUIRED.items():
        out = out.config(key, value)
    return out.config("spark.scheduler.mode", "FAIR").config("spark.sql.execution.arrow.pyspark.enabled", "true")


def ensure(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session that somebody else built."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
