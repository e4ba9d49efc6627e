"""Observed history of a current-state table: versions with the window in which each change happened.

A version is valid in [_valid_from, _valid_to); its change happened in (_changed_after, _valid_from]. Deletes make a
version of their own when the table carries a deletion flag among the hashed columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplane.functions.hashing import business_columns, row_hash
from lakeplane.operators.upsert import same_key

# Control columns and origins of versions.
FROM, TO, AFTER, COLUMNS, ORIGIN = "_valid_from", "_valid_to", "_changed_after", "_hash_columns", "_version_origin"
SEED, OBSERVED = "seed", "observed"


def hash_columns(current: DataFrame, extra: Sequence[str] = ("_is_deleted",)) -> list[str]:
    return [*business_columns(current), *[c for c in extra if c in current.columns]]


def _version(df: DataFrame, columns: Sequence[str], start: Column, after: Column, origin: str) -> DataFrame:
    return df.withColumns({FROM: start.cast("timestamp"), TO: F.lit(None).cast("timestamp"), AFTER: after.cast("timestamp"), COLUMNS: F.lit(",".join(columns)), ORIGIN: F.lit(origin)})


def seed(current: DataFrame, at: datetime) -> DataFrame:
    """Every row as its first version; nobody knows since when it has been so."""
    return _version(current, hash_columns(current), F.lit(at), F.lit(None), SEED)


def observe(history: DataFrame, current: DataFrame, keys: Sequence[str], at: datetime, last: datetime | None) -> DataFrame:
    """The history after looking at the table at ``at``; ``last`` is when it was looked at before."""
    known = hash_columns(history)
    common = [c for c in hash_columns(current) if c in known]
    old = history.where(F.col(TO).isNull()).withColumn("_common", row_hash(common)).alias("t")
    new = current.withColumn("_common", row_hash(common)).alias("s")
    changed = F.col("s._common") != F.col("t._common")
    open_now = old.join(new.select(*keys, "_common").alias("s"), same_key("t", "s", keys), "left")
    open_now = open_now.select(*[F.when(changed, F.lit(at)).otherwise(F.col(f"t.{TO}")).alias(TO) if c == TO else F.col(f"t.`{c}`") for c in history.columns])
    fresh = new.join(old.select(*keys, "_common").alias("t"), same_key("s", "t", keys) & ~changed, "left_anti").drop("_common")
    added = _version(fresh, common, F.lit(at), F.lit(last), OBSERVED)
    return history.where(F.col(TO).isNotNull()).unionByName(open_now).unionByName(added, allowMissingColumns=True)


def reconcile(history: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, side of rows that the current versions and the table don't share; empty if all is well."""
    common = [c for c in hash_columns(current) if c in history.columns]
    a = history.where(F.col(TO).isNull()).select(*keys, row_hash(common).alias("_h")).alias("a")
    b = current.select(*keys, row_hash(common).alias("_h")).alias("b")
    on = same_key("a", "b", [*keys, "_h"])
    return a.join(b, on, "left_anti").select(*keys, F.lit("history").alias("side")).unionByName(b.join(a, same_key("b", "a", [*keys, "_h"]), "left_anti").select(*keys, F.lit("current").alias("side")))


def as_of(history: DataFrame, at: datetime) -> DataFrame:
    """The rows that were valid at a time."""
    t = F.lit(at)
    return history.where((F.col(FROM) <= t) & (F.col(TO).isNull() | (F.col(TO) > t)))


def changes_between(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, change, and the new row: the change feed of two versions of a table."""
    columns = [c for c in after.columns if c in before.columns]
    old, new = before.select(*keys, row_hash(columns).alias("_h")).alias("o"), after.withColumn("_h", row_hash(columns)).alias("n")
    joined = old.join(new, same_key("o", "n", keys), "full_outer")
    change = F.when(F.col("o._h").isNull(), "insert").when(F.col("n._h").isNull(), "delete").when(F.col("o._h") != F.col("n._h"), "update")
    out = joined.select(change.alias("_change"), *[F.coalesce(F.col(f"n.`{c}`"), F.col(f"o.`{c}`")).alias(c) if c in keys else F.col(f"n.`{c}`") for c in after.columns])
    return out.where(F.col("_change").isNotNull())


def replay(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The table at a point: the nearest snapshot before it and the ordered changes since, each change once per key."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*changes.columns), F.col(order)).alias("r")).select("r.*")
    kept = snapshot.alias("t").join(last.alias("s"), same_key("t", "s", keys), "left_anti")
    return kept.unionByName(last.where(F.col("_change") != "delete").select(*snapshot.columns))


def is_reseed(changes: DataFrame, table_rows: int, fraction: float = 0.9) -> bool:
    """Whether one commit deletes and inserts nearly the whole table, which is a reload and no news."""
    n = changes.agg(F.sum((F.col("_change") == "delete").cast("long")), F.sum((F.col("_change") == "insert").cast("long"))).first()
    return table_rows > 0 and min(n[0] or 0, n[1] or 0) >= fraction * table_rows


def require_unbroken(needed: Sequence[int], available: Sequence[int]) -> None:
    """An error if a version that the history needs is gone."""
    if lost := sorted(set(needed) - set(available)):
        raise RuntimeError(f"history is degraded: versions {lost} are no longer available")
