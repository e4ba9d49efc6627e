"""Names, functions, storage, configuration and workers."""

from __future__ import annotations

import io
import json
import sqlite3
import threading
import zipfile
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path

import pytest
from helpers import rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeplane import naming
from lakeplane.audit import Audit
from lakeplane.config import Config
from lakeplane.functions.cleanse import apply_cleansing
from lakeplane.functions.hashing import row_hash, row_hash_v2
from lakeplane.functions.masks import dynamic, keep_last
from lakeplane.operators import discovery, effective_history, quality, shape
from lakeplane.operators.dimensions import gold_merge, scd2
from lakeplane.operators.upsert import latest_per_key, parity, require_unique, upsert
from lakeplane.naming import landed_table
from lakeplane.plans import mirror, runner, workers
from lakeplane.plans.dag import topo_levels
from lakeplane.plans.workers import Context
from lakeplane.scratch import cut
from lakeplane.security import members, predicate, secure, upsert_roles
from lakeplane.sources import databases, extract, files, registry
from lakeplane.sources.databases import jdbc_options, read_dbapi, retrying
from lakeplane.sources.http import choose_member
from lakeplane.storage import Conflict, TableStore
from lakeplane.streaming import intake

T1, T2, T3, T4 = (datetime(2024, m, 1) for m in (1, 2, 3, 4))


@pytest.fixture
def ctx(spark, tmp_path):
    return Context(spark, TableStore(spark, f"file://{tmp_path}/lake"), Config({}))


# --- pure functions


def test_names():
    assert [naming.snake(x) for x in ("ModifiedDate", "SalesOrderID", "already_snake", "HTTPCode2X")] == ["modified_date", "sales_order_id", "already_snake", "http_code2_x"]
    assert [naming.ident(x) for x in ("Stats Can", "British Columbia!!", "  a--b__c ", None)] == ["stats_can", "british_columbia", "a_b_c", ""]
    assert naming.unique_names(["a", "a", "a_2", "a"]) == ["a", "a_2", "a_2_2", "a_3"]
    assert naming.sanitised(["A2:2", "A2-2", "", "x y"]) == ["A2_2", "A2_2_2", "col2", "x_y"]
    assert naming.landed_table({"source_name": "Stats Can", "source_schema": None, "source_table": "labour_force", "suffix": "bc"}) == ("stats_can", "dbo_labour_force_bc")
    assert naming.landed_table({"source_name": "voc", "source_table": "x", "source_options_json": '{"landed": {"table": "Survey Q1"}}'}) == ("voc", "survey_q1")
    assert naming.landed_table({"source_name": None, "source_table": "x", "source_options_json": "no json"}) == ("dbo", "dbo_x")


@given(st.lists(st.text("abAB_ 2", max_size=4)))
def test_unique_names_are_unique(names):
    out = naming.unique_names(names)
    assert len(set(out)) == len(out) == len(names) and naming.unique_names(out) == out


def test_levels():
    assert topo_levels("abc", [("a", "b"), ("b", "c"), ("a", "c"), ("z", "a")]) == [["a"], ["b"], ["c"]]
    with pytest.raises(ValueError, match="circle"):
        topo_levels("ab", [("a", "b"), ("b", "a")])


# --- expressions


def test_selection_and_filters(spark):
    df = spark.createDataFrame([("1", " a "), ("x", None)], "n string, t string")
    assert shape.apply_select(df, ["nope"]).columns == ["n", "t"] and shape.apply_select(df, None) is df
    assert rows(shape.apply_select(df, [{"source": "n", "name": "i", "type": "int"}])) == [(1,), (None,)]
    assert shape.apply_select(df, {"rename": {"n": "m"}, "cast": {"m": "double"}}).dtypes == [("m", "double"), ("t", "string")]
    assert shape.ingest_filter(df, {"t": "a", "other": 1}).count() == 1
    assert shape.newer_than(df, "n", None).count() == 2
    assert shape.drop_empty_columns(df.withColumn("e", F.lit(None).cast("string"))).columns == ["n", "t"]


def test_watermark_reaches_the_scan(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    plan = shape.newer_than(spark.read.parquet(f"{tmp_path}/t"), "id", "5")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in plan


def test_hash_borders(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), (None, "<NULL>"), ("<NULL>", None)], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 2
    assert df.select(row_hash_v2(["x", "y"])).distinct().count() == 4
    assert df.select(row_hash([])).distinct().count() == 1


def test_cleanse_errors_and_fills(spark):
    df = spark.createDataFrame([(None, " A \t b ", "31/01/2024"), (3, "  ", "bad")], "n int, t string, d string")
    rules = [{"function": "fill_nulls", "columns": "n", "parameters_json": '{"default": "7"}'}, {"function": "normalize_text", "columns": "t", "parameters_json": '{"case": "title"}'}, {"function": "parse_datetime", "columns": "d", "parameters_json": '{"formats": ["yyyy-MM-dd", "dd/MM/yyyy"]}'}]
    assert rows(apply_cleansing(df, rules).withColumn("d", F.col("d").cast("string"))) == [(3, None, None), (7, "A B", "2024-01-31")]
    for rule in ({"function": "no"}, {"function": "trim", "columns": "zz"}):
        with pytest.raises(ValueError):
            apply_cleansing(df, [rule])
    with pytest.raises(ValueError, match="key"):
        apply_cleansing(df, [{"function": "trim", "columns": "t"}], keys=["t"])


def test_masks(spark):
    df = spark.createDataFrame([("ab", "x@y.org", 5), (None, None, None)], "s string, m string, n int")
    out = df.select(keep_last(F.col("s")), keep_last(F.col("s"), least=5), dynamic("email()", F.col("m"), df.schema["m"].dataType), dynamic("default()", F.col("n"), df.schema["n"].dataType), dynamic('partial(1,"-",1)', F.col("m"), df.schema["m"].dataType))
    assert rows(out) == [("***ab", "***", "xXXX@XXXX.com", 0, "x-g"), (None, None, None, None, None)]
    with pytest.raises(ValueError):
        dynamic("no()", F.col("s"), df.schema["s"].dataType)


def test_rules_lose_no_row(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    rules = [{"rule_id": "r", "rule_type": "expression", "column_name": None, "rule_expression": "x = 'a'", "severity": "ERROR"}, {"rule_id": "w", "rule_type": "not_null", "column_name": "X", "severity": "warn"}]
    checked = quality.evaluate(df, rules)
    good, bad = quality.split(checked)
    assert good.count() == 1 and bad.count() == 2
    assert rows(quality.summary(checked, rules)) == [("r", 2, 1, "FAIL"), ("w", 1, 2, "FAIL")]
    assert rows(quality.summary(quality.evaluate(df.where("false"), rules), rules)) == [("r", 0, 0, "PASS"), ("w", 0, 0, "PASS")]
    for wrong in ({"rule_type": "min", "column_name": "zz"}, {"rule_type": "odd", "column_name": "x"}):
        with pytest.raises(ValueError):
            quality.evaluate(df, [{"rule_id": "e", "severity": "error", **wrong}])


# --- keyed tables


def test_upsert_and_latest(spark):
    a = spark.createDataFrame([(None, "n"), (1, "o"), (2, "k")], "id int, v string")
    b = spark.createDataFrame([(None, "N", 1), (1, "O", 2)], "id int, v string, extra int")
    assert rows(upsert(a, b, ["id"])) == [(1, "O", 2), (2, "k", None), (None, "N", 1)]
    again = upsert(upsert(a, b, ["id"]), b, ["id"])
    assert rows(again) == rows(upsert(a, b, ["id"]))
    ties = spark.createDataFrame([(1, "x", T1), (1, "y", T1), (1, "old", datetime(2020, 1, 1))], "id int, v string, at timestamp")
    first = latest_per_key(ties, ["id"], "at").collect()
    assert first == latest_per_key(ties.orderBy(F.desc("v")), ["id"], "at").collect() and len(first) == 1
    with pytest.raises(ValueError, match="id=1"):
        require_unique(ties, ["id"])
    assert {r["status"] for r in parity(a, a, "s").collect()} == {"PASS"}


def test_type_two(spark):
    stage = lambda *v: spark.createDataFrame(list(v), "id int, v string")
    out = scd2(None, stage((1, "a"), (None, "n"), (3, "s")), ["id"], F.lit(T1))
    out = scd2(out, stage((1, "b"), (None, "n")), ["id"], F.lit(T2))
    out = cut(scd2(out, stage((1, "c"), (None, "n2"), (4, "new")), ["id"], F.lit(T3)))
    one = [(r["v"], r["_effective_start_ts"], r["_effective_end_ts"], r["_is_current"]) for r in out.where("id = 1").orderBy("_effective_start_ts").collect()]
    assert one == [("a", T1, T2, False), ("b", T2, T3, False), ("c", T3, None, True)]
    assert out.where("id is null").count() == 2 and out.where("id = 3 and _is_current").count() == 1
    assert out.where("_is_current").groupBy("id").count().agg(F.max("count")).first()[0] == 1
    assert rows(scd2(out, stage((1, "c")), ["id"], F.lit(T4)).select("id", "v")) == rows(out.select("id", "v"))
    wider = scd2(out, stage((1, "c")).withColumn("more", F.lit(1)), ["id"], F.lit(T4))
    assert wider.where("id = 1").count() == 3  # a new column alone makes no version
    dated = stage((1, "d")).withColumn("_effective_start_ts", F.lit(T3 + timedelta(5)))
    assert scd2(out, dated, ["id"], F.lit(T4)).where("v = 'c'").first()["_effective_end_ts"] == T3 + timedelta(5)
    with pytest.raises(ValueError):
        gold_merge(None, stage((1, "a"), (1, "b")), "scd1", ["id"], "r", T1)
    with pytest.raises(ValueError):
        gold_merge(None, stage((1, "a")), "other", ["id"], "r", T1)


def test_observed_history(spark):
    cur = lambda *v: spark.createDataFrame(list(v), "id int, v string, _is_deleted boolean")
    h = effective_history.seed(cur((1, "a", False), (2, "b", False)), T1)
    now = cur((1, "a", False), (2, "b", True), (3, "c", False))
    h = cut(effective_history.observe(h, now, ["id"], T2, T1))
    assert effective_history.reconcile(h, now, ["id"]).isEmpty() and h.where("id = 2").count() == 2
    assert h.where("id = 2 and _valid_to is null").first()["_changed_after"] == T1
    assert effective_history.as_of(h, datetime(2024, 1, 15)).count() == 2
    assert not effective_history.reconcile(h, cur((1, "z", False)), ["id"]).isEmpty()
    changes = effective_history.changes_between(cur((1, "a", False)), cur((2, "a", False)), ["id"])
    assert effective_history.is_reseed(changes, 1) and not effective_history.is_reseed(changes, 100)
    with pytest.raises(RuntimeError):
        effective_history.require_unbroken([1, 2], [2])


# --- storage and configuration


def test_store(ctx, spark):
    s = ctx.store
    df = spark.createDataFrame([(1,)], "a int")
    assert not s.exists("silver", "t") and s.commit("silver", "t") is None
    s.write(df, "silver", "t")
    s.write(spark.createDataFrame([(2, "x")], "a int, b string"), "silver", "t", mode="append")
    assert rows(s.read("silver", "t")) == [(1, None), (2, "x")] and rows(s.read("silver", "t", version=0)) == [(1,)]
    assert rows(s.added("silver", "t")) == [(2, "x")] and s.commit("silver", "t").rows == 1
    s.update("silver", "t", lambda old: old.where("a = 2"))
    assert s.versions("silver", "t") == [0, 1, 2] and s.read("silver", "t").count() == 1
    with pytest.raises(Conflict):
        s.write(df, "silver", "t", base=0)
    with pytest.raises(ValueError):
        s.write(spark.createDataFrame([("s",)], "a string"), "silver", "t", mode="append")
    one = s.write(df, "bronze", "u", mode="append", tag="q:1")
    assert s.write(df, "bronze", "u", mode="append", tag="q:1") == one and s.read("bronze", "u").count() == 1
    with pytest.raises(FileNotFoundError):
        s.read("gold", "none")
    assert sorted(s.reset(keep_layers=["config", "silver"])) == ["bronze"]


def sample_config() -> dict:
    return {
        "datasource": [{"source_id": 1, "source_name": "crm", "source_type": "staged", "load_group": 1}],
        "source_object": [{"object_id": "o", "source_id": 1, "source_table": "Person", "load_type": "full", "key_columns_json": ["PersonID"], "processing_state": "ACTIVE"}],
        "steps": [{"load_group": 1, "step_order": i, "step_key": k, "is_active": 1} for i, k in enumerate(("metadata", "bronze", "silver"))],
    }


def test_config_round_trip(tmp_path, spark):
    config = Config(sample_config())
    config.dump(tmp_path)
    again = Config.load(tmp_path)
    assert all(again.ordered(t) == config.ordered(t) for t in config.tables)
    assert config.steps(1) == {"metadata": True, "bronze": True, "silver": True}
    assert [o["object_id"] for o in config.objects(1)] == ["o"] and config.objects(2) == [] and config.history(1) == []
    config.register_views(spark)
    assert spark.sql("SELECT * FROM config_source_object JOIN config_datasource USING (source_id)").count() == 1
    for wrong in ({"nope": []}, {"datasource": [{"source_id": None}]}, {"dq_rule": [{"rule_id": "r", "object_id": "zz"}]}, {"model": [{"bad": 1}]}):
        with pytest.raises(ValueError):
            Config(wrong)


def test_audit(ctx):
    a = Audit(ctx.store)
    a.create_tables()
    a.create_tables()
    assert a.watermark("o") is None
    a.set_watermark("o", 5)
    a.set_watermark("o", 7)
    assert a.watermark("o") == "7"
    a.record_column_map("o", "s", "t", [("a2_2", "A2:2"), ("same", "same")])
    a.record_column_map("o", "s", "t", [("a2_2", "A2:2")])
    assert a.headers("s", "t") == {"a2_2": "A2:2"} and a.headers("other", "t") == {}
    a.log_failure("p", "r", 1, "x", "e" * 9000)
    assert len(a.read("pipeline_run_log").first()["message"]) == 4000


# --- workers


def stage_file(spark, tmp_path, name: str, data: list, schema: str) -> str:
    path = f"file://{tmp_path}/{name}"
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(path)
    return path


def person(path: str, **more) -> dict:
    return {"object_id": "o", "source_id": 1, "source_name": "crm", "source_type": "staged", "source_table": "Person", "load_type": "full", "key_columns_json": '["PersonID"]', "source_options_json": json.dumps({"path": path}), **more}


def test_soft_delete_scenario(ctx, spark, tmp_path):
    first = [(i, f"name {i}") for i in range(10)]
    second = [(i, f"name {i}" + "!" * (i < 2)) for i in range(9)]
    for k, data in enumerate((first, second)):
        o = person(stage_file(spark, tmp_path, f"s{k}", data, "PersonID int, FullName string"))
        workers.bronze(ctx, o, f"r{k}")
        workers.silver(ctx, o, f"r{k}")
    silver = ctx.store.read("silver", "dbo_person", "crm")
    assert silver.count() == 10 and ctx.store.read("bronze", "dbo_person", "crm").count() == 19
    assert [r["person_id"] for r in silver.where("_is_deleted").collect()] == [9]
    assert silver.where("full_name like '%!'").count() == 2
    again = workers.silver(ctx, o, "r2")
    assert again.rows == 10
    back = person(stage_file(spark, tmp_path, "s3", first, "PersonID int, FullName string"))
    workers.bronze(ctx, back, "r3")
    workers.silver(ctx, back, "r3")
    assert ctx.store.read("silver", "dbo_person", "crm").where("_is_deleted").count() == 0
    empty = person(stage_file(spark, tmp_path, "s4", [], "PersonID int, FullName string"))
    workers.bronze(ctx, empty, "r4")
    workers.silver(ctx, empty, "r4")
    assert ctx.store.read("silver", "dbo_person", "crm").where("_is_deleted").count() == 0
    workers.silver(ctx, empty, "r5", allow_empty_snapshot=True)
    assert ctx.store.read("silver", "dbo_person", "crm").where("_is_deleted").count() == 10
    assert ctx.audit.headers("crm", "dbo_person") == {"person_id": "PersonID", "full_name": "FullName"}


def test_quarantine_and_history(spark, tmp_path):
    rules = [{"rule_id": "q", "object_id": "o", "column_name": "Age", "rule_type": "min", "min_value": 0, "severity": "error"}]
    cleanse = [{"rule_id": "c", "object_id": "o", "function": "trim", "columns": "name"}]
    ctx = Context(spark, TableStore(spark, f"file://{tmp_path}/lake"), Config(sample_config() | {"dq_rule": rules, "cleanse_rule": cleanse}))
    for k, data in enumerate(([(1, " a ", 5), (2, "b", -1)], [(1, "a", 6), (2, "b", 1)])):
        o = person(stage_file(spark, tmp_path, f"s{k}", data, "PersonID int, Name string, Age int"))
        workers.bronze(ctx, o, f"r{k}")
        workers.silver(ctx, o, f"r{k}")
        workers.history(ctx, o, f"r{k}")
    assert ctx.store.read("silver", "quarantine_dbo_person", "crm").count() == 1
    assert rows(ctx.audit.read("dq_result").select("run_id", "failed_count", "passed_count")) == [("r0", 1, 1), ("r1", 0, 2)]
    history = ctx.store.read("silver", "dbo_person_history", "crm")
    assert rows(history.select("person_id", "age", "_version_origin")) == [(1, 5, "seed"), (1, 6, "observed"), (2, 1, "observed")]


def test_incremental_and_keyless(ctx, spark, tmp_path):
    inc = {"load_type": "incremental", "watermark_column": "n", "source_table": "log", "key_columns_json": "[]"}
    for k, data in enumerate(([(1,), (2,)], [(2,), (3,)])):
        o = person(stage_file(spark, tmp_path, f"s{k}", data, "n int"), **inc)
        workers.bronze(ctx, o, f"r{k}")
    assert rows(ctx.store.read("bronze", "dbo_log", "crm").select("n")) == [(1,), (2,), (3,)] and ctx.audit.watermark("o") == "3"
    plain = {"source_table": "plain", "key_columns_json": '["_row_hash"]'}
    for k, data in enumerate(([("x",), ("x",), ("y",)], [("z",), ("z",)])):
        o = person(stage_file(spark, tmp_path, f"p{k}", data, "v string"), **plain)
        workers.bronze(ctx, o, f"r{k}")
        workers.silver(ctx, o, f"r{k}")
    assert rows(ctx.store.read("silver", "dbo_plain", "crm").select("v")) == [("z",)]
    with pytest.raises(FileNotFoundError):
        workers.bronze(ctx, person("file:///nowhere"), "r")
    assert ctx.audit.read("object_load_run").where("status = 'FAILED'").count() == 1


def test_run_of_a_load_group(spark, tmp_path):
    tables = sample_config()
    tables["source_object"][0]["source_options_json"] = {"path": stage_file(spark, tmp_path, "s", [(1, "a"), (2, "b")], "PersonID int, Name string")}
    tables["steps"].append({"load_group": 1, "step_order": 9, "step_key": "gold", "is_active": True})
    tables["model"] = [{"model_id": 1, "model_name": "m", "load_group": 1}]
    tables["gold_object"] = [{"gold_object_id": g, "model_id": 1, "gold_type": t, "stage_table": g, "gold_table": g, "business_key_columns_json": ["person_id"], "source_query_notebook": g} for g, t in (("dim_person", "scd2"), ("fact_person", "fact"))]
    tables["gold_dependency"] = [{"parent_gold_object_id": "dim_person", "child_gold_object_id": "fact_person"}]
    ctx = Context(spark, TableStore(spark, f"file://{tmp_path}/lake"), Config(tables))
    queries = {"dim_person": lambda s, read, run: read("silver", "dbo_person", "crm").select("person_id", "name"), "fact_person": lambda s, read, run: read("gold", "dim_person").where("_is_current").select("person_id")}
    assert runner.run(ctx, 1, queries, "r1") == "r1"
    runner.run(ctx, 1, queries, "r2")
    assert ctx.store.read("gold", "dim_person").count() == 2 and ctx.store.read("gold", "fact_person").count() == 2
    assert rows(ctx.audit.read("ingestion_run").where("run_completed_at is not null").select("run_id", "status")) == [("r1", "SUCCEEDED"), ("r2", "SUCCEEDED")]
    with pytest.raises(KeyError):
        runner.run(ctx, 1, {}, "r3")
    assert ctx.audit.read("pipeline_run_log").first()["activity"] == "gold"
    assert runner.plan(ctx, 1, "models")[0]["model_id"] == 1
    with pytest.raises(ValueError):
        runner.plan(ctx, 1, "no")


def test_drift_is_reported_once(spark):
    now = lambda *names: spark.createDataFrame([("o", n, "int") for n in names], "object_id string, column_name string, source_data_type string")
    empty = spark.createDataFrame([], "object_id string, column_name string, source_data_type string, discovered_at timestamp, is_active boolean")
    assert discovery.snapshot_drift(empty, now("a", "b"), "r0", T1).count() == 0
    state = cut(discovery.merge_snapshot(empty, now("a", "b"), T1))
    assert rows(discovery.snapshot_drift(state, now("a", "c"), "r1", T2).select("column_name", "drift_type", "severity")) == [("b", "COLUMN_REMOVED", "warning"), ("c", "COLUMN_ADDED", "info")]
    state = cut(discovery.merge_snapshot(state, now("a", "c"), T2))
    assert discovery.snapshot_drift(state, now("a", "c"), "r2", T3).count() == 0
    events = [{"object_id": "o", "column_name": "b", "drift_type": "COLUMN_REMOVED"}, {"object_id": "o", "column_name": "c", "drift_type": "COLUMN_ADDED"}]
    assert discovery.rename_suspects(events, {("o", "b"): "int", ("o", "c"): "int"}) == [("o", "b", "c")]
    assert [c["source_table"] for c in discovery.discover({"source_type": "statcan_wds", "connection_json": '{"table_id": [14, 15]}'})] == ["14", "15"]
    assert discovery.discover({"source_type": "file"}) is None


def test_security(spark):
    df = spark.createDataFrame([(1, "a", "eu"), (2, "b", "us")], "id int, name string, region string")
    policies = [{"policy_id": "1", "method": "RLS", "role_name": "r", "predicate": "select * from t where region = 'eu'"}, {"policy_id": "2", "method": "CLS", "role_name": "r", "columns": "id;name"}, {"policy_id": "3", "method": "DDM", "columns": "name", "mask_function": "default()"}]
    assert rows(secure(df, policies, "r")) == [(1, "xxxx")]
    assert secure(df, policies, "other").columns == ["id", "name", "region"] and secure(df, policies, "other").count() == 2
    with pytest.raises(ValueError):
        secure(df, [{"method": "CLS", "columns": "zz"}], "r")
    assert members({"members_json": '["x", {"id": "y", "type": "User"}]'}) == [{"id": "x", "type": "Group"}, {"id": "y", "type": "User"}]
    assert predicate({"predicate": "select * from t"}) == "true"
    assert [r["v"] for r in upsert_roles([{"name": "a", "v": 1}, {"name": "b", "v": 1}], [{"name": "b", "v": 2}])] == [1, 2]


# --- connectors


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *args):
        pass

    def do_POST(self):
        self.answer({"access_token": "t"})

    def do_GET(self):
        base = f"http://127.0.0.1:{self.server.server_port}"
        if self.path.startswith("/json"):
            self.answer({"data": {"items": [{"id": 1, "a": {"b": "x"}, "tags": [1]}, {"id": 2, "a": None, "c-d": "y"}]}})
        elif self.path.startswith("/zip.json"):
            self.answer({"object": f"{base}/file.zip"})
        elif self.path.startswith("/file.zip"):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("t_MetaData.csv", "x\n1\n")
                z.writestr("t.csv", "GEO,VALUE\nBC ,1.50\nON,\n")
            self.answer(out.getvalue())
        elif "/groups?" in self.path:
            self.answer({"value": [{"id": "g1"}, {"id": "g2"}]})
        elif "/members" in self.path and "page" not in self.path:
            self.answer({"value": [{"id": "m1"}], "@odata.nextLink": f"{base}{self.path.split('?')[0]}?page=2"})
        else:
            self.answer({"value": [{"id": "m2"}]})

    def answer(self, body):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body if isinstance(body, bytes) else json.dumps(body).encode())


@pytest.fixture(scope="module")
def server():
    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def http_object(server: str, kind: str = "http", **opts) -> dict:
    return {"object_id": "h", "source_type": kind, "connection_json": json.dumps({"base_url": server, "login_url": server, "tenant_id": "t"}), "source_options_json": json.dumps(opts)}


def test_http(spark, server):
    out = extract(spark, http_object(server, path="/json/{x}", params={"x": 1}, response={"type": "json", "record_path": "data.items"}))
    assert out.columns == ["a", "a_b", "c_d", "id", "tags"] and out.count() == 2
    out = extract(spark, http_object(server, "statcan", path="/zip.json", response={"type": "zip_csv"}, filters={"GEO": "BC"}))
    assert rows(out.select("GEO", "VALUE")) == [("BC ", "1.50")]
    assert choose_member(["a.csv", "b.csv"], "b", None) == "b.csv"
    with pytest.raises(ValueError):
        choose_member(["a.txt"], None, None)


def test_graph(spark, server):
    out = extract(spark, http_object(server, "entra", entity="groups", subresource="members"))
    assert rows(out.select("group_id", "id")) == [("g1", "m1"), ("g1", "m2"), ("g2", "m1"), ("g2", "m2")]


def test_dbapi(spark, tmp_path):
    cn = sqlite3.connect(tmp_path / "d.db")
    cn.executescript("create table t(a int, b text); insert into t values (1, 'x'), (2, null);")
    cn.commit()
    cn.close()
    assert rows(read_dbapi(spark, "sqlite3", "select * from t", str(tmp_path / "d.db"))) == [("1", "x"), ("2", None)]
    empty = read_dbapi(spark, "sqlite3", "select * from t where a > 5", str(tmp_path / "d.db"))
    assert empty.columns == ["a", "b"] and empty.count() == 0
    with pytest.raises(Exception, match="not installed"):
        read_dbapi(spark, "no_such_driver", "select 1").count()


def test_dbapi_keeps_types(spark, tmp_path):
    cn = sqlite3.connect(tmp_path / "d.db")
    cn.executescript("create table t(a int, b real, c text, d text, e int, f text); insert into t values (7, 1.5, '12.30', '2024-02-03 04:05:06', 1, 'x'), (null, null, null, null, null, null);")
    cn.commit()
    cn.close()
    schema = "a bigint, b double, c decimal(10,2), d timestamp, e boolean, f string"
    out = read_dbapi(spark, "sqlite3", "select * from t order by a desc", str(tmp_path / "d.db"), schema=schema)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "decimal(10,2)", "timestamp", "boolean", "string"]
    first = out.where("a is not null").first()
    assert (first["a"], first["b"], str(first["c"]), first["d"].day, first["e"], first["f"]) == (7, 1.5, "12.30", 3, True, "x") and out.where("a is null and f is null").count() == 1


def test_catalogues_are_asked(spark, ctx, monkeypatch):
    """The catalogue queries run as they are on a database with an information schema."""
    import duckdb
    import pandas as pd

    from lakeplane.operators import discovery
    from lakeplane.sources import catalogs

    con = duckdb.connect()
    con.execute("create schema hr; create table hr.staff(id int, day date, x int, primary key(day, id)); create table hr.log(x int); create view hr.v as select 1 as a")

    def run(source, sql):
        return spark.createDataFrame(con.sql(sql).df().astype(object).where(lambda d: pd.notna(d), None), "t_s string, t_n string" + (", c_n string, ord long" if "c_n" in sql else ""))

    try:
        catalogs.register(run)
        for connector in ("postgresql", "sqlserver"):
            found = {(c["source_schema"], c["source_table"]): c["key_columns"] for c in discovery.discover({"connector": connector})}
            assert sorted(found["hr", "staff"]) == ["day", "id"] and found["hr", "log"] == [] and ("hr", "v") not in found
        ctx.config.tables["datasource"].append({"source_id": 9, "source_name": "pg", "source_type": "postgresql", "database_name": None, "load_group": 9, "ingestion_mode": None, "is_active": True, "connector": "postgresql", "connection_json": None, "secret_name": None})
        assert workers.metadata(ctx, 9, "r1")["new_objects"] >= 2 and workers.metadata(ctx, 9, "r2")["new_objects"] == 0
        again = Config.kept(ctx.store, Config({"datasource": [ctx.config.tables["datasource"][-1]]}))
        assert {o["source_table"] for o in again.tables["source_object"]} >= {"staff", "log"} and not any(o["is_active"] for o in again.tables["source_object"] if o["source_id"] == 9)
    finally:
        catalogs.register()
    asked = []
    monkeypatch.setattr(catalogs, "extract", lambda s, o: asked.append(json.loads(o["source_options_json"])["query"]) or spark.createDataFrame([], "T_S string, T_N string, C_N string, ORD long"))
    for connector in ("oracle", "db2", "mysql"):
        assert discovery.discover({"connector": connector}) == []
    assert len(asked) == 6 and any("all_tables" in q for q in asked) and any("syscat.tables" in q for q in asked)


def test_mirrored_versions(ctx, spark, tmp_path):
    source = TableStore(spark, str(tmp_path / "elsewhere"))
    source.write(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "bronze", "t")
    obj = {"object_id": "m", "source_id": 1, "source_name": "erp", "source_schema": None, "source_table": "t", "load_type": "full", "ingestion_mode": "mirror", "key_columns_json": '["id"]', "source_options_json": json.dumps({"mirror": {"root": source.root, "table": "t"}})}
    first = workers.bronze(ctx, obj, "r1")
    assert first.rows == 2 and ctx.audit.watermark("m") == "0"
    assert workers.bronze(ctx, obj, "r2").version == first.version
    source.write(spark.createDataFrame([(1, "a2")], "id int, v string"), "bronze", "t")
    assert workers.bronze(ctx, obj, "r3").rows == 1 and ctx.audit.watermark("m") == "1"
    workers.silver(ctx, obj, "r3")
    schema, table = landed_table(obj)
    assert rows(ctx.store.read("silver", table, schema).select("id", "v", "_is_deleted")) == [(1, "a2", False), (2, "b", True)]
    pinned = obj | {"object_id": "p", "source_options_json": json.dumps({"mirror": {"root": source.root, "table": "t", "version": 0}})}
    assert mirror.pinned(spark, pinned, None)[1].count() == 2 and mirror.pinned(spark, pinned, "0") is None
    with pytest.raises(FileNotFoundError):
        mirror.pinned(spark, obj | {"source_options_json": json.dumps({"mirror": {"root": source.root, "table": "none"}})}, None)


def test_store_upkeep(ctx, spark):
    s, one = ctx.store, spark.createDataFrame([(1,)], "a int")
    for k in range(6):
        s.write(one, "bronze", "t", mode="append", tag=f"q:{k}")
    for late in (5, 2):
        assert s.write(one, "bronze", "t", mode="append", tag=f"q:{late}").version == 5
    s.write(one, "bronze", "t", mode="append", tag="other:0")
    assert s.commit("bronze", "t").tags == {"q": "5", "other": "0"} and s.read("bronze", "t").count() == 7
    s.compact("bronze", "t")
    assert len(s.commit("bronze", "t").folders) == 1 and s.read("bronze", "t").count() == 7 and s.commit("bronze", "t").tags["q"] == "5"
    assert s.vacuum("bronze", "t") == []
    gone = s.vacuum("bronze", "t", keep_versions=1, older_than=timedelta(0))
    assert len(gone) == 7 and s.versions("bronze", "t") == [7] and s.read("bronze", "t").count() == 7


def test_connection_options(monkeypatch):
    monkeypatch.setenv("SECRET_CRM", '{"host": "h", "user": "u", "password": "p"}')
    conn = registry.connection({"secret_name": "crm", "connection_json": '{"database": "d"}'})
    assert jdbc_options(conn, "postgresql") == {"url": "jdbc:postgresql://h:5432/d", "fetchsize": "10000", "driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    monkeypatch.setenv("SECRET_CRM", "jdbc:x")
    assert jdbc_options(registry.connection({"secret_name": "crm"}), "mysql")["url"] == "jdbc:x"
    assert registry.resolve({"source_type": "MSSQL"}) == "sqlserver" and registry.resolve({}) == "sqlserver"
    with pytest.raises(ValueError, match="o1"):
        extract(None, {"object_id": "o1", "connector": "nothing"})
    assert databases.partition_options({"partitionColumn": "id"}) == {}
    assert registry.dig({"a": [{"b": 1}]}, "a.0.b") == 1
    calls = []
    assert retrying(lambda: calls.append(1) or (1 if len(calls) > 1 else (_ for _ in ()).throw(OSError("connect timeout"))), wait=0) == 1
    row, secret = registry.onboard("My CRM", 3, "postgresql", 1, {"host": "h", "password": "p"})
    assert "password" not in row["connection_json"] and json.loads(secret) == {"password": "p"} and row["secret_name"] == "my-crm"


def workbook(path: Path, sheets: dict[str, list[list[str | None]]]) -> None:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, data in enumerate(sheets.values()):
            body = "".join("<row>" + "".join(f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(data))
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_intake(ctx, tmp_path):
    new = tmp_path / "drop" / "newfile" / "VOC"
    new.mkdir(parents=True)
    (new / "people__key=Id.csv").write_text('Id,Full Name,Empty,A2:2\n1,"Ann, B",,x\n2,Bo,,y\n')
    (new / "notes.txt").write_text("a;b\n1;2\n1;2\n")
    (new / "ignored.pdf").write_text("x")
    workbook(new / "book.xlsx", {"One": [["k", "v"], ["1", None], ["2", "z"]], "Two": [["h"], ["q"]]})
    done = intake.scan(ctx, str(tmp_path / "drop"), "r1")
    assert sorted(done.values()) == ["FAILED", "LOADED", "LOADED", "LOADED"]
    people = ctx.store.read("silver", "people", "voc")
    assert rows(people.select("id", "full__name", "a2_2")) == [("1", "Ann, B", "x"), ("2", "Bo", "y")] and "empty" not in people.columns
    assert ctx.audit.headers("voc", "people")["a2_2"] == "A2:2"
    assert ctx.store.read("silver", "notes", "voc").count() == 1
    assert rows(ctx.store.read("silver", "book_one", "voc").select("k", "v")) == [("1", None), ("2", "z")] and ctx.store.exists("silver", "book_two", "voc")
    assert len(list((tmp_path / "drop" / "archive").rglob("*.*"))) == 3
    (new / "people__key=Id.csv").write_text('Id,Full Name,Empty,A2:2\n1,"Ann, B",,x\n2,Bo,,y\n')
    assert "SEEN" in intake.scan(ctx, str(tmp_path / "drop"), "r2").values()
    (new / "people__key=Id.csv").write_text("Id,Full Name,A2:2\n1,Ann C,x\n")
    intake.scan(ctx, str(tmp_path / "drop"), "r3")
    assert rows(ctx.store.read("silver", "people", "voc").select("id", "full__name", "_is_deleted")) == [("1", "Ann C", False), ("2", "Bo", True)]


def test_stream_takes_each_file_once(ctx, spark, tmp_path):
    new = tmp_path / "drop" / "newfile" / "s"
    new.mkdir(parents=True)
    (new / "f.csv").write_text("a\n1\n")
    for _ in range(2):
        intake.stream(ctx, str(tmp_path / "drop"), f"{tmp_path}/cp", "r").awaitTermination()
    (new / "g.csv").write_text("a\n2\n")
    intake.stream(ctx, str(tmp_path / "drop"), f"{tmp_path}/cp", "r").awaitTermination()
    assert ctx.audit.read("dropbox_ledger").count() == 2 and ctx.store.read("silver", "g", "s").count() == 1
    spark.range(5).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        source = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        intake.append_stream(spark, source, ctx, "bronze", "ev", "dbo", f"{tmp_path}/cp2").awaitTermination()
    assert ctx.store.read("bronze", "ev").count() == 5


def test_paths_of_drops():
    d = intake.Drop.of("/x/newfile/My%20Schema/Sales__key=a,b.CSV")
    assert (d.schema, d.stem, d.kind, d.keys) == ("my_schema", "sales", "csv", ("a", "b"))
    assert intake.Drop.of("plain.txt").schema == "dbo" and intake.Drop.of("x/newfile/a/b/c.csv").schema == "a"
    with pytest.raises(ValueError):
        intake.Drop.of("newfile/x/readme")


def test_delimiter(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a|b\n1|2\n3|4\n")
    assert files.sniff(spark, f"{tmp_path}/a.txt") == "|"
