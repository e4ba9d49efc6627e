"""Keyed tables without MERGE: latest rows, upserts and soft deletes. Keys compare null-safe."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplane.functions.hashing import business_columns, row_hash


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The newest row of each key; among equally new ones that with the greatest row hash.

    An aggregation, not a window: rows are reduced before the shuffle, and a key of any size is no group in memory.
    """
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(F.col(at), row_hash(business_columns(df))))
    return df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(best.alias("r")).select("r.*")


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the source's rows replaced those with their keys; columns of either side are kept.

    The source has one row per key.
    """
    if target is None:
        return source
    kept = target.alias("t").join(source.alias("s"), same_key("t", "s", keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def mark_deleted(df: DataFrame, alive: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Add _is_deleted and _deleted_at: rows whose key isn't among the newest snapshot's keys."""
    present = alive.select(*[F.col(f"`{k}`") for k in keys]).distinct().withColumn("_present", F.lit(True))
    out = df.alias("d").join(present.alias("p"), same_key("d", "p", keys), "left").select("d.*", F.col("p._present").isNull().alias("_is_deleted"))
    return out.withColumn("_deleted_at", F.when(F.col("_is_deleted"), at.cast("timestamp")))


def duplicate_keys(df: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Keys that occur more than once, the most frequent first; ``top`` limits the report."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1).orderBy(F.desc("n_rows"), *keys)
    return out.limit(top) if top else out


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "stage") -> DataFrame:
    """The frame itself; an error that names keys and counts if a key occurs twice."""
    if rows := duplicate_keys(df, keys, 10).collect():
        named = "; ".join(", ".join(f"{k}={r[k]}" for k in keys) + f" ({r['n_rows']} rows)" for r in rows)
        raise ValueError(f"{what} has several rows for a key: {named}")
    return df


def parity(source: DataFrame, target: DataFrame, scope: str) -> DataFrame:
    """check_scope, check_name, source_value, target_value, status: row count and content of two tables."""
    columns = sorted(set(business_columns(source)) & set(business_columns(target)))
    content = F.coalesce(F.bit_xor(F.xxhash64(row_hash(columns))), F.lit(0)).cast("string")
    side = lambda df, name: df.agg(F.count(F.lit(1)).cast("string").alias("row_count"), content.alias("content")).withColumn("side", F.lit(name))
    long = side(source, "source").unionByName(side(target, "target")).unpivot(["side"], ["row_count", "content"], "check_name", "value")
    pick = lambda s: F.max(F.when(F.col("side") == s, F.col("value")))
    out = long.groupBy("check_name").agg(pick("source").alias("source_value"), pick("target").alias("target_value"))
    return out.select(F.lit(scope).alias("check_scope"), "check_name", "source_value", "target_value", F.when(F.col("source_value").eqNullSafe(F.col("target_value")), "PASS").otherwise("FAIL").alias("status"))
