"""Workers of a load: bronze, silver, gold and metadata for single objects and models."""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane.audit import Audit
from lakeplane.config import Config, columns
from lakeplane.functions.cleanse import apply_cleansing
from lakeplane.functions.hashing import business_columns, with_row_hash
from lakeplane.naming import landed_table, physical_names, snake, utc_now
from lakeplane.operators import discovery, quality
from lakeplane.operators.dimensions import gold_merge
from lakeplane.operators.effective_history import observe, reconcile, seed
from lakeplane.operators.shape import apply_select, stamp_bronze
from lakeplane.operators.upsert import latest_per_key, mark_deleted, parity, upsert
from lakeplane.plans import mirror
from lakeplane.plans.dag import topo_levels
from lakeplane.scratch import cut, release
from lakeplane.sources import extract
from lakeplane.sources.databases import watermarked
from lakeplane.sources.files import read_file
from lakeplane.sources.registry import options, resolve
from lakeplane.storage import Commit, TableStore

Object = Mapping[str, object]
#: A model query: (spark, read a table by layer, schema and name, run id) to the stage rows.
ModelQuery = Callable[[SparkSession, Callable[..., DataFrame], str], DataFrame]


@dataclass
class Context:
    """What workers share."""

    spark: SparkSession
    store: TableStore
    config: Config

    @cached_property
    def audit(self) -> Audit:
        return Audit(self.store)


@dataclass(frozen=True)
class SilverPlan:
    """How an object's silver table is built, decided from its configuration alone."""

    schema: str
    table: str
    keys: tuple[str, ...]
    snapshot: bool
    soft_delete: bool

    @classmethod
    def of(cls, obj: Object) -> SilverPlan:
        schema, table = landed_table(obj)
        keys = tuple(snake(k) for k in json.loads(str(obj.get("key_columns_json") or "[]")) or [])
        keys = () if keys == ("_row_hash",) else keys
        snapshot = str(obj.get("load_type") or "full").lower() != "incremental"
        off = str(options(obj).get("delete_detection", "")).lower() == "off"
        return cls(schema, table, keys, snapshot, bool(keys) and snapshot and not off)


def _guarded(ctx: Context, layer: str, obj: Object, run_id: str, work: Callable[[], Commit | None]) -> Commit | None:
    """Run a worker; an error leaves its trace in a text file and a row in the log."""
    started = utc_now()
    try:
        return work()
    except Exception as e:
        ctx.store.put_text(f"error_{layer}_{obj.get('object_id', 'x')}_{run_id}.txt", traceback.format_exc())
        ctx.audit.log_load(run_id, str(obj.get("object_id")), layer, "FAILED", started=started, details={"error": str(e)[:500]})
        raise


def bronze(ctx: Context, obj: Object, run_id: str) -> Commit | None:
    """Extract, select, stamp and append; the count and the new watermark come from the write itself.

    The watermark moves only after the rows are committed, and only for incremental objects. An empty extract is a
    commit too: a snapshot without rows means that everything is gone.
    """

    def work() -> Commit:
        schema, table = landed_table(obj)
        object_id = str(obj["object_id"])
        version = None
        if mirror.is_mirrored(obj):
            pinned = mirror.pinned(ctx.spark, obj, ctx.audit.watermark(object_id))
            if pinned is None:  # nothing new: no batch, so that nothing looks removed
                ctx.audit.log_load(run_id, object_id, "bronze", "SKIPPED", details={"reason": "version unchanged"})
                return ctx.store.commit("bronze", table, schema)
            version, df = pinned
        elif resolve(obj) in ("file", "dropbox"):
            df, pairs = read_file(ctx.spark, obj)
            ctx.audit.record_column_map(object_id, schema, table, pairs)
        else:
            df = extract(ctx.spark, obj)
        df = df if version is not None else watermarked(df, obj, ctx.audit.watermark(object_id))
        mark = str(obj.get("watermark_column") or "")
        mark = mark if version is None and str(obj.get("load_type") or "").lower() == "incremental" and mark in df.columns else ""
        seen = {"watermark": F.max(mark)} if mark else {}
        label = ".".join(str(p) for p in (obj.get("source_schema"), obj.get("source_table")) if p)
        if mark and mark not in apply_select(df, options(obj).get("select")).columns:
            raise ValueError(f"object {object_id!r}: its selection leaves out the watermark column {mark!r}")
        rows = stamp_bronze(apply_select(df, options(obj).get("select")), run_id, str(obj.get("source_name") or ""), label, utc_now())
        commit = ctx.store.write(rows, "bronze", table, schema, "append", run_id, observe=seen)
        if mark or version is not None:
            ctx.audit.set_watermark(object_id, commit.stats.get("watermark") if version is None else version)
        ctx.audit.log_load(run_id, object_id, "bronze", "SUCCEEDED", source=commit.rows, target=commit.rows)
        return commit

    return _guarded(ctx, "bronze", obj, run_id, work)


def _renamed(df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Bronze rows under silver names, and (new, old) of every business column."""
    columns = business_columns(df)
    pairs = list(zip(physical_names(columns), columns))
    kept = [F.col(f"`{old}`").alias(new) for new, old in pairs if new != "rowguid"]
    return df.select(*kept, "_bronze_ingest_ts"), pairs


def silver_rows(plan: SilverPlan, bronze_rows: DataFrame, latest: DataFrame, cleanse_rules: list[Object]) -> DataFrame:
    """Current rows before rules: the newest per key over all batches, or the latest batch, or everything; cleansed."""
    if plan.keys:
        rows = latest_per_key(bronze_rows, plan.keys, "_bronze_ingest_ts")
    else:
        rows = latest if plan.snapshot else bronze_rows
    return apply_cleansing(rows.drop("_bronze_ingest_ts"), cleanse_rules, plan.keys)


def silver(ctx: Context, obj: Object, run_id: str, allow_empty_snapshot: bool = False) -> Commit | None:
    """Build an object's silver table: current rows, cleansed, checked, quarantined, hashed, upserted or overwritten.

    The newest batch is read from its own commit. All rules are evaluated in one pass, and their counts come with the write
    of the checked rows. Deletes are marked on the target's rows as well, so that a key whose newest row was rejected is
    still flagged. An empty snapshot flags everything only if ``allow_empty_snapshot`` says so.
    """

    def work() -> Commit | None:
        plan, object_id, store = SilverPlan.of(obj), str(obj["object_id"]), ctx.store
        newest = store.commit("bronze", plan.table, plan.schema)
        if newest is None:
            return None
        rows, pairs = _renamed(store.read("bronze", plan.table, plan.schema))
        latest, _ = _renamed(store.added("bronze", plan.table, plan.schema))
        if missing := [k for k in plan.keys if k not in rows.columns]:
            raise ValueError(f"object {object_id!r}: key columns {missing} do not exist")
        if resolve(obj) not in ("file", "dropbox"):
            ctx.audit.record_column_map(object_id, plan.schema, plan.table, pairs)
        rules = ctx.config.active("dq_rule", object_id=object_id)
        current = silver_rows(plan, rows, latest, ctx.config.active("cleanse_rule", object_id=object_id))
        checked, seen = quality.observed(quality.evaluate(current, rules), rules)
        checked = written = cut(checked)
        counts, at = seen.get, utc_now()  # one time for all that this run writes
        if rules:
            ctx.audit.append("dq_result", [{"run_id": run_id, "object_id": object_id, "rule_id": r["rule_id"], "failed_count": counts[f"failed_{i}"], "passed_count": counts["rows"] - counts[f"failed_{i}"], "status": "FAIL" if counts[f"failed_{i}"] else "PASS", "evaluated_at": at} for i, r in enumerate(rules)])
        good, bad = quality.split(checked)
        if counts["rejected"]:
            store.write(bad.withColumns({"_run_id": F.lit(run_id), "_quarantined_at": F.lit(at)}), "silver", f"quarantine_{plan.table}", plan.schema, "append", run_id)
        good = with_row_hash(good).withColumns({"_silver_run_id": F.lit(run_id), "_silver_updated_at": F.lit(at)})
        if not plan.keys:
            commit = store.write(good.dropDuplicates(["_row_hash"]), "silver", plan.table, plan.schema, "overwrite", run_id)
        else:
            deleting = plan.soft_delete and (newest.rows or allow_empty_snapshot)
            gone_at = F.lit(latest.agg(F.max("_bronze_ingest_ts")).first()[0] or at) if deleting else None

            def change(old: DataFrame | None) -> DataFrame:
                if old is not None:
                    old = old.drop("_is_deleted", "_deleted_at") if deleting else old
                new = upsert(old, good, plan.keys)
                return mark_deleted(new, latest, plan.keys, gone_at) if deleting else new

            commit = store.update("silver", plan.table, change, plan.schema, run_id)
        ctx.audit.log_load(run_id, object_id, "silver", "SUCCEEDED", source=counts["rows"], target=commit.rows, quarantine=counts["rejected"])
        release(written)
        return commit

    return _guarded(ctx, "silver", obj, run_id, work)


def history(ctx: Context, obj: Object, run_id: str) -> Commit | None:
    """Look at an object's silver table and keep what changed in ``<table>_history``; an error if they disagree then."""

    def work() -> Commit | None:
        plan, store = SilverPlan.of(obj), ctx.store
        if not plan.keys:
            raise ValueError(f"object {obj.get('object_id')!r} has no key, so it can't have a history")
        at, name = utc_now(), f"{plan.table}_history"
        current = store.read("silver", plan.table, plan.schema)
        last = store.commit("silver", name, plan.schema)
        if last is None:
            commit = store.write(seed(current, at), "silver", name, plan.schema, "overwrite", run_id, base=-1)
        else:
            commit = store.update("silver", name, lambda old: observe(old, current, plan.keys, at, datetime.fromisoformat(last.at)), plan.schema, run_id)
        if not reconcile(store.read("silver", name, plan.schema), current, plan.keys).isEmpty():
            raise RuntimeError(f"the history of {plan.schema}.{plan.table} doesn't agree with its table")
        return commit

    return _guarded(ctx, "history", obj, run_id, work)


def gold(ctx: Context, model_id: int, run_id: str, queries: Mapping[str, ModelQuery]) -> dict[str, Commit]:
    """Build a model's gold tables, parents first; a missing parent table is an error."""
    objects = {str(o["gold_object_id"]): o for o in ctx.config.active("gold_object", model_id=model_id)}
    edges = [(str(e["parent_gold_object_id"]), str(e["child_gold_object_id"])) for e in ctx.config.tables["gold_dependency"]]
    every = {str(o["gold_object_id"]): o for o in ctx.config.tables["gold_object"]}
    out = {}
    for parent, child in edges:
        if child in objects and parent not in objects and not ctx.store.exists("gold", str(every[parent]["gold_table"])):
            raise RuntimeError(f"{child} needs {parent}, which is not active and has no table")

    def read(layer: str, table: str, schema: str = "dbo") -> DataFrame:
        return ctx.store.read(layer, table, schema)

    for level in topo_levels(objects, edges):
        for name in level:
            o = objects[name]

            def work(o: Object = o, name: str = name) -> Commit:
                stage_name, table = str(o.get("stage_table") or name), str(o["gold_table"])
                ctx.store.write(queries[str(o["source_query_notebook"])](ctx.spark, read, run_id), "gold", stage_name, "stage", "overwrite", run_id)
                stage, at = ctx.store.read("gold", stage_name, "stage"), utc_now()
                keys = json.loads(str(o.get("business_key_columns_json") or "[]"))
                commit = ctx.store.update("gold", table, lambda old: gold_merge(old, stage, str(o["gold_type"]), keys, run_id, at), run_id=run_id)
                ctx.audit.log_load(run_id, name, "gold", "SUCCEEDED", target=commit.rows)
                return commit

            out[name] = _guarded(ctx, "gold", {"object_id": name}, run_id, work)
    return out


def metadata(ctx: Context, load_group: int, run_id: str) -> dict[str, int]:
    """Register new tables of the sources that can be asked, inactive, and take a column snapshot of each object.

    Returns the number of new objects and of drift events. A source that fails is logged and doesn't stop the others.
    """
    ctx.audit.create_tables()
    new, events = 0, 0
    for source in ctx.config.active("datasource", load_group=load_group):
        try:
            found = discovery.discover(source)
        except Exception as e:
            ctx.audit.log_failure("metadata", run_id, load_group, f"discover {source['source_name']}", e)
            continue
        known = {(o["source_schema"], o["source_table"]) for o in ctx.config.tables["source_object"] if o["source_id"] == source["source_id"]}
        for c in found or []:
            if (c["source_schema"], c["source_table"]) not in known:
                new += 1
                row = dict.fromkeys(columns("source_object"))
                row |= {"object_id": "_".join(str(p) for p in (source["source_name"], c["source_schema"], c["source_table"]) if p).lower(), "source_id": source["source_id"], "source_schema": c["source_schema"], "source_table": c["source_table"], "load_type": "full", "key_columns_json": json.dumps(c["key_columns"]), "is_active": False, "processing_state": "ACTIVE"}
                ctx.config.tables["source_object"].append(row)
    if new:
        ctx.config.keep(ctx.store, "source_object")
    at = utc_now()
    rows = []
    for o in ctx.config.objects(load_group):
        schema, table = landed_table(o)
        if ctx.store.exists("bronze", table, schema):
            rows += [(str(o["object_id"]), f.name, f.dataType.simpleString()) for f in ctx.store.added("bronze", table, schema).schema.fields if not f.name.startswith("_")]
    if rows:
        now = ctx.spark.createDataFrame(rows, "object_id string, column_name string, source_data_type string")
        before = ctx.audit.read("source_column")
        drift = discovery.snapshot_drift(before, now, run_id, at)
        events = ctx.store.write(drift, "config", "schema_drift_event", mode="append").rows or 0
        ctx.store.update("config", "source_column", lambda old: discovery.merge_snapshot(old if old is not None else before, now, at))
    return {"new_objects": new, "drift_events": events}


def check_parity(ctx: Context, obj: Object, source: DataFrame, target: DataFrame, run_id: str) -> DataFrame:
    out = parity(source, target, "table").withColumns({"run_id": F.lit(run_id), "object_id": F.lit(str(obj["object_id"])), "checked_at": F.lit(utc_now())})
    ctx.store.write(out.select(*ctx.audit.frame("parity_result", []).columns), "config", "parity_result", mode="append")
    return out
