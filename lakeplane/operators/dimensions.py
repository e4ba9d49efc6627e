"""Gold strategies: type 1 and type 2 dimensions and facts, as one rewrite of the target each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplane.functions.hashing import business_columns, row_hash
from lakeplane.operators.upsert import require_unique, same_key, upsert

Strategy = Callable[[DataFrame | None, DataFrame, Sequence[str], Column], DataFrame]
STRATEGIES: dict[str, Strategy] = {}
#: Control columns of a type 2 dimension.
START, END, CURRENT, HASH = "_effective_start_ts", "_effective_end_ts", "_is_current", "_row_hash"


def strategy(*names: str) -> Callable[[Strategy], Strategy]:
    def register(fn: Strategy) -> Strategy:
        STRATEGIES.update(dict.fromkeys(names, fn))
        return fn

    return register


@strategy("scd1", "fact")
def by_key(target: DataFrame | None, stage: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Type 1 dimensions and facts: rows replace those with their key, so that a load can be repeated."""
    return upsert(target, stage, keys)


@strategy("scd2")
def scd2(target: DataFrame | None, stage: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Type 2: a changed key's current version is closed and a new one opened, both at one time.

    The time is the stage's own ``_effective_start_ts`` where it has one, else ``at``. A change is decided over the
    business columns that both sides have, hashed anew on both. Closed versions stay as they are; keys that the stage
    doesn't have stay open; the stage's control columns beside its hash are kept.
    """
    own = [c for c in stage.columns if c not in (START, END, CURRENT, HASH)]
    start = F.coalesce(F.col(START), at) if START in stage.columns else at
    incoming = stage.select(*[F.col(f"`{c}`") for c in own], row_hash(business_columns(stage)).alias(HASH), start.cast("timestamp").alias(START), F.lit(None).cast("timestamp").alias(END), F.lit(True).alias(CURRENT))
    if target is None:
        return incoming
    common = [c for c in business_columns(stage) if c in target.columns]
    old = target.where(F.col(CURRENT)).withColumn("_common", row_hash(common)).alias("t")
    new = incoming.withColumn("_common", row_hash(common)).alias("s")
    changed = F.col("s._common") != F.col("t._common")
    # one join decides on the current versions, one on the stage
    versions = old.join(new.select(*[F.col(f"`{k}`") for k in keys], "_common", START).alias("s"), same_key("t", "s", keys), "left")
    versions = versions.select(*[F.when(changed, F.col(f"s.{START}")).otherwise(F.col(f"t.{END}")).alias(END) if c == END else F.coalesce(~changed, F.lit(True)).alias(CURRENT) if c == CURRENT else F.col(f"t.`{c}`") for c in target.columns])
    same = new.join(old.select(*[F.col(f"`{k}`") for k in keys], "_common").alias("t"), same_key("s", "t", keys) & ~changed, "left_anti").drop("_common")
    closed = target.where(~F.coalesce(F.col(CURRENT), F.lit(False)))
    return closed.unionByName(versions).unionByName(same, allowMissingColumns=True)


def gold_merge(target: DataFrame | None, stage: DataFrame, gold_type: str, keys: Sequence[str], run_id: str, at: datetime) -> DataFrame:
    """The target after a load: stage keys must be unique, rows are stamped with the run."""
    if gold_type not in STRATEGIES:
        raise ValueError(f"unknown gold type {gold_type!r}; known: {sorted(STRATEGIES)}")
    stamped = require_unique(stage, keys).withColumns({"_gold_run_id": F.lit(run_id), "_gold_updated_at": F.lit(at)})
    return STRATEGIES[gold_type](target, stamped, keys, F.lit(at))
