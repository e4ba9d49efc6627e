"""Readers of the tables that queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeplane.session import ensure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ensure(spark).read.parquet(f"{folder}/{name}.parquet")
