"""Operators of the general data problems against brute force on small, dirty tables."""

from __future__ import annotations

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeplane.functions.tree_edit import assign, build, edit_script
from lakeplane.operators import bitmap_history, grouped, hierarchy, profile, references, schema_drift, snapshot_diff
from lakeplane.plans import data_problems

T0 = datetime(2024, 1, 1)

# --- chunked groups


def test_chunks_change_nothing(spark):
    data = [("hot", i * 7 % 1000, i % 5 + 1) for i in range(1000)] + [("cold", 5, 1), (None, 1, 2), (None, 3, 4)]
    df = spark.createDataFrame(data, "k string, at long, v long")
    whole = grouped.previous_rows(df, ["k"], "at", ["at", "v"])
    cut = grouped.previous_rows(df, ["k"], "at", ["at", "v"], chunk_rows=20)
    assert rows(whole) == rows(cut.select(*whole.columns))
    chunked, chunk = grouped.time_chunks(df, ["k"], "at", 20)
    assert chunk and chunked.where("k = 'hot'").groupBy(chunk).count().agg(F.max("count")).first()[0] <= 60
    sums = grouped.prefix_sums(chunked, ["k"], ["at"], {"before": "v"}, chunk).select("k", "at", "v", "before")
    assert rows(sums) == rows(grouped.prefix_sums(df, ["k"], ["at"], {"before": "v"}))


# --- hierarchies


def brute_hierarchy(links: set[tuple[str, str]], nodes: set[str]) -> set[tuple[str, str, int]]:
    parents, children = defaultdict(set), defaultdict(set)
    for a, b in links:
        parents[b].add(a)
        children[a].add(b)
    waiting = {n: len(parents[n]) for n in nodes}
    ready = [n for n in nodes if not waiting[n]]
    depth: dict[str, dict[str, int]] = {n: {n: 0} for n in ready}
    done = set()
    while ready:
        n = ready.pop()
        done.add(n)
        for c in children[n]:
            for root, d in depth[n].items():
                depth.setdefault(c, {})[root] = max(depth.get(c, {}).get(root, 0), d + 1)
            waiting[c] -= 1
            if not waiting[c]:
                ready.append(c)
    return {(n, r, d) for n in done for r, d in depth[n].items()} | {(n, "", -1) for n in nodes - done}


def random_links(seed: int, n: int) -> list[tuple[str | None, str | None]]:
    rnd = random.Random(seed)
    links = [(f"n{rnd.randrange(max(0, i - 6), i)}", f"n{i}") for i in range(1, n) if rnd.random() > 0.08]
    links += [(f"n{rnd.randrange(i)}", f"n{i}") for i in range(1, n) if rnd.random() < 0.2]
    links += [(f"n{rnd.randrange(n)}", f"n{rnd.randrange(n)}") for _ in range(2)] + [("self", "self"), ("a", "b"), ("b", "a"), ("b", "below")]
    return links + links[:5] + [(" n1\t", "n2 "), (None, "alone"), ("lonely", None), (None, None)]


@pytest.mark.parametrize(("seed", "n"), [(1, 40), (2, 60), (3, 12)])
def test_hierarchy_matches_brute_force(spark, seed, n):
    data = random_links(seed, n)
    clean = [(a and a.strip(), b and b.strip()) for a, b in data]
    nodes = {x for p in clean for x in p if x is not None}
    links = {(a, b) for a, b in clean if a and b}
    out = hierarchy.hierarchy(*hierarchy.clean_links(spark.createDataFrame(data, "p string, c string"), "p", "c"), with_path=True)
    got = out.collect()
    assert {(r["node"], r["root"], r["depth"]) for r in got} == brute_hierarchy(links, nodes)
    for r in got:
        if r["depth"] >= 0:
            assert r["path"][0] == r["root"] and r["path"][-1] == r["node"] and len(r["path"]) == r["depth"] + 1
            assert all(p in links for p in zip(r["path"], r["path"][1:]))


def test_descendant_ranges(spark):
    data = random_links(5, 40)
    pair = hierarchy.clean_links(spark.createDataFrame(data, "p string, c string"), "p", "c")
    place = {r["node"]: (r["head"], r["lft"]) for r in hierarchy.hierarchy(*pair).collect() if r["depth"] >= 0}
    ranges = defaultdict(list)
    for r in hierarchy.descendants(*pair).collect():
        ranges[r["node"]].append((r["head"], r["lft"], r["rgt"]))
    children = defaultdict(set)
    for a, b in {(x[0].strip(), x[1].strip()) for x in data if x[0] and x[1]}:
        children[a].add(b)
    for node in place:
        below, todo = {node}, [node]
        while todo:
            for c in children[todo.pop()] - below:
                below.add(c)
                todo.append(c)
        got = {n for n, (h, at) in place.items() if any(h == rh and lo <= at <= hi for rh, lo, hi in ranges[node])}
        assert got == below & set(place)


@pytest.mark.parametrize("seed", [5, 6])
def test_descendants_on_and_below_cycles(spark, seed):
    data = [*random_links(seed, 25), ("A", "B"), ("B", "C"), ("C", "B"), ("C", "D"), ("r3", "r1"), ("r1", "r2"), ("r2", "r3"), ("r2", "a0"), ("r2", "J"), ("A", "J")]
    pair = hierarchy.clean_links(spark.createDataFrame(data, "p string, c string"), "p", "c")
    place = {r["node"]: (r["head"], r["lft"]) for r in hierarchy.hierarchy(*pair, place_cycles=True).collect()}
    children = defaultdict(set)
    for a, b in {(x[0].strip(), x[1].strip()) for x in data if x[0] and x[1]}:
        children[a].add(b)
    out = [tuple(r) for r in hierarchy.descendants(*pair).select("node", "head", "lft", "rgt").collect()]
    assert len(out) == len(set(out)) and len(set(place.values())) == len(place) and None not in {h for h, _ in place.values()}
    for node in place:
        below, todo = {node}, [node]
        while todo:
            for c in children[todo.pop()] - below:
                below.add(c)
                todo.append(c)
        assert {n for n, (h, at) in place.items() if any(node == r and h == rh and lo <= at <= hi for r, rh, lo, hi in out)} == below


def test_long_chain_and_wide_parent(spark):
    data = [(f"c{i}", f"c{i + 1}") for i in range(300)] + [("hub", f"leaf{i}") for i in range(400)]
    links, nodes = hierarchy.clean_links(spark.createDataFrame(data, "p string, c string"), "p", "c")
    places = {r["node"]: r for r in hierarchy.nested_sets(links, nodes, chunk_rows=50).collect()}
    assert places["c300"]["depth"] == 300 and places["c0"]["size"] == 301
    assert sorted(places[f"leaf{i}"]["lft"] for i in range(400)) == list(range(1, 401))


def test_ladder_of_diamonds_in_few_rounds(spark, monkeypatch):
    n, rounds = 600, []
    data = [x for i in range(n) for x in ((f"n{i}", f"a{i}"), (f"n{i}", f"b{i}"), (f"b{i}", f"c{i}"), (f"a{i}", f"n{i + 1}"), (f"c{i}", f"n{i + 1}"))]
    data += [("r1", f"n{n}x"), (f"n{n}", f"n{n}x"), (f"n{n}x", "end")]
    links, nodes = hierarchy.clean_links(spark.createDataFrame(data, "p string, c string"), "p", "c")
    real = hierarchy.cut
    monkeypatch.setattr(hierarchy, "cut", lambda df: rounds.append(1) or real(df))
    got = {(r["node"], r["root"]): r["depth"] for r in hierarchy.hierarchy(links, nodes).collect()}
    assert got[f"n{n}", "n0"] == 3 * n and got["end", "n0"] == 3 * n + 2 and got["end", "r1"] == 2 and got[f"a{n - 1}", "n0"] == 3 * n - 2
    assert len(got) == 4 * n + 1 + 1 + 4 and len(rounds) < 45


def test_no_links(spark):
    links, nodes = hierarchy.clean_links(spark.createDataFrame([], "p string, c string"), "p", "c")
    assert hierarchy.hierarchy(links, nodes).count() == 0


# --- references

FACT = "id long, line long, at timestamp, customer_key long, product_key long, extra string"
REFS = [references.Reference("customer_key", "c", valid_from="start"), references.Reference("product_key", "p", deleted="gone", deleted_at="gone_at")]


def dims(spark) -> dict:
    c = [(1, T0), (1, T0 + timedelta(9)), (2, T0 + timedelta(5)), (None, T0)]
    p = [(1, None, None), (2, True, T0 + timedelta(2)), (3, False, T0), (4, None, T0)]
    return {"c": spark.createDataFrame(c, "customer_key long, start timestamp"), "p": spark.createDataFrame(p, "product_key long, gone boolean, gone_at timestamp")}


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_bad_references(spark, monkeypatch, limit):
    monkeypatch.setattr(references, "BROADCAST_BYTES", limit)
    data = [(1, 1, T0, 1, 1, "x"), (1, 1, T0, 1, 1, "y"), (1, 2, T0, 2, 2, ""), (1, 3, T0 + timedelta(3), 9, 2, ""), (1, 4, None, 2, 2, ""), (1, 5, None, 9, 9, ""), (1, 6, T0, None, None, ""), (1, 7, T0, 1, 3, ""), (1, 8, T0, 1, 4, ""), (1, 3, T0 + timedelta(3), 9, 2, "again")]
    out = references.check_references(spark.createDataFrame(data, FACT), ["id", "line"], "at", REFS, dims(spark))
    got = {(r["line"], r["ref_column"], r["kind"]) for r in out.collect()}
    assert out.count() == len(got)
    assert got == {(2, "customer_key", "late"), (3, "customer_key", "missing"), (3, "product_key", "deleted"), (5, "customer_key", "missing"), (5, "product_key", "missing")}


def test_ledger_of_deltas(spark):
    df = spark.createDataFrame([(i, i, T0, i % 7, i % 5, "") for i in range(100)], FACT)
    columns = ["customer_key", "product_key"]
    d = dims(spark)
    exists = [references.existence_delta(d[r.dimension], r) for r in REFS]
    whole = references.merge_ledger(references.reference_delta(df, columns, "at"), *exists)
    step = references.merge_ledger(references.reference_delta(df.where("id < 60"), columns, "at"), exists[0])
    step = references.merge_ledger(step, references.reference_delta(df.where("id >= 60"), columns, "at"), exists[1])
    assert rows(references.orphans(whole)) == rows(references.orphans(step))
    removed = references.merge_ledger(step, references.reference_delta(df.where("customer_key = 3"), ["customer_key"], "at", -1))
    before, after = ({(r["ref_column"], r["key"]) for r in references.orphans(x).collect()} for x in (step, removed))
    assert before - after == {("customer_key", 3)}
    assert references.merge_ledger(references.reference_delta(df.where("false"), columns, "at")).count() == 0


# --- profiles


def conforming(spark, df, columns, **more):
    """{column: (expressions, {value: conforms})} by the operator."""
    typed = profile.with_forms(profile.value_counts(df, F.lit("l"), columns)).persist()
    forms = profile.induce(typed, **more)
    out = {c: ([], {}) for c in columns}
    for r in forms.collect():
        out[r["column"]][0].append(r["expression"])
    for r in profile.match(typed, forms).where("value is not null").collect():
        assert r["value"] not in out[r["column"]][1]
        out[r["column"]][1][r["value"]] = r["key"] is not None
    return out


def test_expressions(spark):
    rnd = random.Random(3)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(64)) for _ in range(300)]
    data = [(f"A-{i:04d}", "open" if i % 2 else "shut", None if i % 10 == 0 else float(i), hexes[i], "x" * i, rnd.choice(["Zoë", "Ann", "Bo"]) + f" {'Q' if i % 3 else 'É'}uick") for i in range(300)]
    data += [("broken one", "OPEN!", -5.0, hexes[0][:9] + "G", "", "_"), ("", "open", None, "\x01\x1a", "\n", "a.b\nc")]
    df = spark.createDataFrame(data, "code string, state string, amount double, hash string, text string, name string")
    out = conforming(spark, df, df.columns)
    assert out["code"][0] == ["[A-Z]\\-[0-9]{4}"] and sorted(out["state"][0]) == ["open", "shut"] and out["hash"][0] == ["[0-9a-f]{64}"]
    for column, (_, values) in out.items():
        wrong = {v for v, ok in values.items() if not ok}
        assert wrong == {"code": {"broken one", ""}, "state": {"OPEN!"}, "hash": {hexes[0][:9] + "G", "\x01\x1a"}}.get(column, wrong)
    # the expressions that come out accept the same values as the tree does
    for column, (forms, values) in out.items():
        both = spark.createDataFrame(list(values.items()), "v string, ok boolean").withColumn("match", F.exists(F.array(*[F.lit(f) for f in forms]), lambda f: F.regexp_like(F.col("v"), F.concat(F.lit(r"\A(?:"), f, F.lit(r")\z")))))
        assert both.where("ok <> match").count() == 0
    assert conforming(spark, df.where("false"), ["code"])["code"] == ([], {})


def test_spelled_expressions():
    for value, level, mask, want in [("a.B-1", 0, 0, r"a\.B\-1"), ("Ab-12", 1, 0, r"[A-Z][a-z]\-[0-9]{2}"), ("Ab_12", 2, 0, "[A-Z]+[a-z]+_[0-9]+"), ("f0-ab", 3, 3, r"[0-9a-f]{2}\-[0-9a-f]{2}"), ("a_1 b", 4, 71, r"[0-9a-z_]+\ [0-9a-z_]+"), ("x", 5, 0, "(?s:.*)"), ("é1", 1, 32, r"[\p{L}&&[^\p{Lu}]]\p{Nd}")]:
        assert profile.expression(value, level, mask) == want


def test_profile_between_loads(spark):
    data = [("a", "x1")] * 10 + [("b", "x1")] * 5 + [("b", "yy")] * 5 + [("b", None)] * 10
    out = {(r["column"], r["load"]): r for r in profile.profile(spark.createDataFrame(data, "load string, v string"), F.col("load"), ["v"]).collect()}
    assert out["v", "a"]["coverage_change"] is None and out["v", "b"]["null_rate"] == 0.5 and out["v", "b"]["n_distinct"] == 2
    assert out["v", "b"]["coverage_change"] == 0.75 and 0 < out["v", "b"]["chance_change"] < 0.3
    assert profile.profile(spark.createDataFrame([], "load string, v string"), F.col("load"), ["v"]).count() == 0
    # nothing changes but the size of the load: a difference stays within what chance gives
    rnd = random.Random(1)
    same = [(f"l{k}", rnd.choice(["a", "b", "c"])) for k, n in enumerate((900, 3, 900)) for _ in range(n)]
    rows_ = profile.profile(spark.createDataFrame(same, "load string, v string"), F.col("load"), ["v"]).where("coverage_change is not null").collect()
    assert len(rows_) == 2 and all(r["coverage_change"] < 3 * r["chance_change"] for r in rows_)


def test_tables_in_one_plan(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "n int, s string"), spark.createDataFrame([("y",)], "s string")
    tables = {"a": (a, F.lit(""), ["n", "s"]), "b": (b, F.lit(""), ["s"])}
    got = {(r["table"], r["column"]): r for r in profile.profile_tables(tables).collect()}
    assert set(got) == {("a", "n"), ("a", "s"), ("b", "s")} and got["a", "n"]["max_number"] == 2.0 and got["a", "s"]["null_rate"] == 0.5 and got["b", "s"]["min_value"] == "y"
    assert {(r["table"], r["column"]) for r in profile.expressions(tables).collect()} <= set(got)


def test_rule_types_without_a_list(spark):
    """Names that make up a tenth of the rows are the expression; spelling variants and rare names are exceptions."""
    right = [n for n, k in (("not_null", 400), ("min", 150), ("max", 140), ("allowed_values", 150), ("expression", 130)) for _ in range(k)]
    wrong = ["regex"] * 5 + ["range"] * 3 + ["unique", "Not_Null", " min", "max ", "MIN", "expr", "maximum"]
    rules = spark.createDataFrame([(str(i), k) for i, k in enumerate([*right, *wrong, None])], "id string, kind string")
    for exact in (None, sorted(set(right))):
        got = profile.nonconforming_rows(rules, "kind", ["id"], exact)
        assert {(int(r["id"]), r["issue"]) for r in got.collect()} == {(len(right) + i, "pattern") for i in range(len(wrong))} | {(len(right) + len(wrong), "null")}


def test_exact_check_and_measures(spark):
    rules = spark.createDataFrame([("1", "min"), ("2", "Min"), ("3", None), ("4", "max"), ("5", "min ")], "id string, kind string")
    assert rows(profile.nonconforming_rows(rules, "kind", ["id"], ["min", "max"])) == [("2", "pattern"), ("3", "null"), ("5", "pattern")]
    at = lambda d: T0 + timedelta(d)
    results = [("r", "1", at(1), 10, 90), ("r", "2", at(2), 40, 60), ("r", "3", at(3), None, 5), ("r", "4", at(4), -1, 5), ("r", "5", at(5), 0, 0), ("r", "6", at(6), 100, 150), ("r", "6", at(0), 0, 1), ("q", "1", at(1), 1, 1)]
    results += [("e", "1", at(1), 20, 80), ("e", "2", at(2), 40, 60), ("e", "3", at(3), 0, 50)]  # a change of exactly 0.2 isn't a shift, a half not less than half
    df = spark.createDataFrame(results, "rule string, run string, at timestamp, f long, p long")
    want = [("e", "3", "shift"), ("r", "2", "shift"), ("r", "3", "null"), ("r", "4", "range"), ("r", "6", "volume")]
    assert rows(profile.measure_issues(df, "rule", "run", "at", "f", "p")) == want
    assert profile.measure_issues(df.where("false"), "rule", "run", "at", "f", "p").count() == 0


def test_every_growing_table_is_profiled(spark, monkeypatch, tmp_path):
    growing = {"dq_result", "dq_rule", "fact_sales_order", "dim_customer", "stage_dim_customer", "bronze_product", "file_row", "raw_record", "documents", "doc_label", "gold_dependency", "source_object", "source_column", "schema_drift_event"}
    assert growing <= set(data_problems.PROFILED)
    spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", None)], "run_id string, n long").write.parquet(f"{tmp_path}/dq_result.parquet")
    monkeypatch.setattr(data_problems, "PROFILED", {"dq_result": data_problems.PROFILED["dq_result"]})
    out = {(r["column"], r["load"]): (r["n_rows"], r["n_distinct"]) for r in data_problems.p3_profile(spark, str(tmp_path)).collect()}
    assert out == {("run_id", "r1"): (2, 1), ("run_id", "r2"): (1, 1), ("n", "r1"): (2, 2), ("n", "r2"): (1, 0)}


# --- drift


def test_edit_scripts():
    old = build([("id", "int", "a"), ("name", "text", "b"), ("addr.street", "text", "c"), ("addr.zip", "text", "d"), ("gone", "int", None)])
    new = build([("id", "bigint", "a"), ("title", "text", "b"), ("place.street", "text", "c"), ("place.zip", "text", "d"), ("fresh", "int", None)])
    cost, steps = edit_script(old, new)
    assert set(steps) == {("TYPE_CHANGED", "id", ""), ("COLUMN_RENAMED", "title", "name"), ("COLUMN_RENAMED", "place", "addr"), ("COLUMN_REMOVED", "gone", ""), ("COLUMN_ADDED", "fresh", "")}
    assert cost == 4
    moved = edit_script(build([("a.x", "int", "m"), ("a.y", "int", None), ("b.z", "int", None)]), build([("a.y", "int", None), ("b.x", "int", "m"), ("b.z", "int", None)]))
    assert moved == (1, [("COLUMN_MOVED", "b.x", "a.x")])
    assert edit_script(build([]), build([])) == (0, [])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5).flatmap(lambda n: st.lists(st.lists(st.integers(0, 9), min_size=n, max_size=n), min_size=n, max_size=n)))
def test_assignment_is_cheapest(cost):
    from itertools import permutations

    best = min(sum(cost[i][p[i]] for i in range(len(cost))) for p in permutations(range(len(cost))))
    assert sum(cost[i][j] for i, j in enumerate(assign(cost))) == best


def drift_tables(spark):
    cols = [("o", "a", "int", 0), ("o", "b", " Varchar", 0), ("o", "b", "varchar", 0), ("o", "n", "int", 0), ("o", "a", "BIGINT", 1), ("o", "c", "varchar", 1), ("o", "m", "int", 1), ("o", "a", "bigint", 2), ("o", "c", "varchar", 2), ("o", "b", "int", 2)]
    columns = spark.createDataFrame([(o, n, t, T0 + timedelta(d), True) for o, n, t, d in cols] + [("o", "off", "int", T0, False), (None, "x", "int", T0, True)], "object_id string, column_name string, source_data_type string, discovered_at timestamp, is_active boolean")
    lines = [(0, 1, '{"a": 1, "b": "x", "n": null}'), (0, 2, '{"b": null, "a": 2, "n": null}'), (0, 3, '{"a": 3, "b": "gone", "n": null}'), (1, 1, '{"a": 1, "c": "x", "m": null}'), (1, 2, '{"a": 2, "c": null, "m": null}'), (1, 2, '{"c": null, "m": null, "a": 2}'), (2, 1, '{"a": 1, "c": "y", "b": 5}')]
    files = spark.createDataFrame([("o", f"f{d}", T0 + timedelta(d), k, j) for d, k, j in lines], "object_id string, file_name string, landed_at timestamp, record_key long, row_json string")
    return columns, files


def test_drift_and_one_table(spark):
    columns, files = drift_tables(spark)
    found = schema_drift.changes(columns, files).persist()
    got = {(r["drift_type"], r["column_name"], r["old_column_name"]) for r in found.collect()}
    # all-null columns give no evidence, so n and m are a removal and an addition
    assert got == {("TYPE_CHANGED", "a", ""), ("COLUMN_RENAMED", "c", "b"), ("COLUMN_REMOVED", "n", ""), ("COLUMN_ADDED", "m", ""), ("COLUMN_REMOVED", "m", ""), ("COLUMN_ADDED", "b", "")}
    lives = schema_drift.lineages(columns, found)
    kinds = {r["target"]: (r["data_type"], r["names"]) for r in schema_drift.target_columns(columns, lives).collect()}
    assert kinds == {"a": ("bigint", "a"), "c": ("varchar", "b,c"), "n": ("int", "n"), "m": ("int", "m"), "b": ("int", "b")}
    out = schema_drift.unify(columns, files, lives)
    assert out.count() == 6
    assert out.where("file_name = 'f0' and record_key = 1").first()["row_json"] == '{"a":"1","b":null,"c":"x","m":null,"n":null}'
    none = schema_drift.changes(columns.where("false"), files)
    assert none.count() == 0


def test_values_take_the_target_type(spark):
    kinds = [("d", ["date", "datetime", "datetime2"]), ("n", ["decimal", " INT", "int"]), ("i", ["int", "bigint", "bigint"]), ("t", ["decimal", "varchar", "varchar"]), ("z", ["datetime", "datetime", "datetime"])]
    columns = spark.createDataFrame([("o", c, k, T0 + timedelta(d), True) for c, ks in kinds for d, k in enumerate(ks)], "object_id string, column_name string, source_data_type string, discovered_at timestamp, is_active boolean")
    lines = [
        (0, '{"d": "2024-06-04", "n": 8088.0, "i": 7, "t": 5.50, "z": "2024-06-04 00:00:00+02:00"}'),
        (1, '{"d": "2024-06-04 00:00:00", "n": 8088, "i": 12345678901234567890123, "t": "5.50", "z": "2024-06-04 10:00:00.1200000"}'),
        (2, '{"d": "2024-06-04T00:00:00", "n": "0.80880E4", "i": "7.5", "t": null, "z": "soon"}'),
    ]
    files = spark.createDataFrame([("o", f"f{d}", T0 + timedelta(d), 1, j) for d, j in lines], "object_id string, file_name string, landed_at timestamp, record_key long, row_json string")
    out = schema_drift.unify(columns, files, schema_drift.lineages(columns, schema_drift.changes(columns, files)))
    got = {r["file_name"]: (json.loads(r["row_json"]), r["n_untyped"]) for r in out.collect()}
    same = {"d": "2024-06-04T00:00:00", "n": "8088"}
    assert got["f0"] == (same | {"i": "7", "t": "5.5", "z": "2024-06-04 00:00:00+02:00"}, 1)
    assert got["f1"] == (same | {"i": "12345678901234567890123", "t": "5.50", "z": "2024-06-04T10:00:00.12"}, 0)
    assert got["f2"] == (same | {"i": "7.5", "t": None, "z": "soon"}, 2)
    texts = [("-0.0", "0"), ("+007.10", "7.1"), (".5", "0.5"), ("5.", "5"), ("1e-30", None), ("", None), ("100", "100"), ("1E3", "1000")]
    df = spark.createDataFrame(texts, "v string, want string").withColumn("got", schema_drift.canonical(F.col("v"), F.lit("decimal")))
    assert [r["got"] for r in df.collect()] == [w for _, w in texts]


# --- history


def brute_versions(data: list[tuple]) -> set[tuple]:
    last: dict = {}
    for key, start, staged, *attrs in data:
        if key is not None and start is not None and (key, start) not in last or (key, start) in last and staged > last[key, start][0]:
            last[key, start] = (staged, tuple(attrs))
    out, by_key = [], defaultdict(list)
    for (key, start), (_, attrs) in sorted(last.items()):
        if not by_key[key] or by_key[key][-1][1] != attrs:
            by_key[key].append((start, attrs))
    for key, versions in by_key.items():
        for i, (start, attrs) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((key, start, end, *attrs, end is None))
    return set(out)


@pytest.mark.parametrize("chunk", [None, 15])
def test_versions(spark, chunk):
    rnd = random.Random(4)
    data = [(1 if rnd.random() < 0.6 else rnd.randrange(2, 9), T0 + timedelta(hours=rnd.randrange(250)), T0 + timedelta(hours=i), rnd.choice(["x", "y", None]), rnd.choice([1, None])) for i in range(500)] + [(None, T0, T0, "x", 1), (3, None, T0, "x", 1)]
    df = spark.createDataFrame(data, "id long, start timestamp, staged timestamp, a string, b long")
    out = bitmap_history.versions(df, "id", "start", "staged", ["a", "b"], chunk)
    got = {(r["id"], r["start_us"], r["end_us"], r["a"], r["b"], r["is_current"]) for r in out.collect()}
    us = lambda t: None if t is None else int((t - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    assert got == {(k, us(s), us(e), a, b, c) for k, s, e, a, b, c in brute_versions(data)} and out.count() == len(got)
    stored = out.select("id", "start_us", "end_us", "a", "b", "is_current")
    assert bitmap_history.compare_history(out, stored.unionByName(stored.limit(5)), "id", ["a", "b"]).count() == 0
    wrong = stored.withColumn("b", F.when(F.col("id") == 2, F.lit(77)).otherwise(F.col("b")))
    assert {r["id"] for r in bitmap_history.compare_history(out, wrong, "id", ["a", "b"]).collect()} == {2}
    assert bitmap_history.versions(df.where("false"), "id", "start", "staged", ["a", "b"]).count() == 0


# --- snapshots


def test_snapshot_differences(spark, monkeypatch):
    rnd = random.Random(3)
    data, state = [], {("s", i): (i % 5, "v") for i in range(400)} | {("t", i): (1, None) for i in range(5)}
    expect = set()
    before: dict = {}
    for snap in range(4):
        at = T0 + timedelta(snap)
        if snap:
            for i in rnd.sample(range(400), 150):
                state["s", i] = (rnd.randrange(5), rnd.choice(["v", None]))
            for i in rnd.sample(range(400), 40):
                state.pop(("s", i), None)
        for (s, i), (n, v) in state.items():
            data.append((s, i, n, v, T0, at, rnd.choice([None, False]), "junk"))
        for key, (n, v) in list(state.items())[:20]:
            data.append((key[0], key[1], n + 100, v, T0 - timedelta(1), at, None, "stale"))
            data.append((key[0], 10_000 + key[1], n, v, T0, at, True, "deleted"))
        now = dict(state)
        if snap:
            for key in now.keys() | before.keys():
                kind = "added" if key not in before else "removed" if key not in now else "changed" if now[key] != before[key] else None
                if kind:
                    expect.add((key[0], snap, str(key[1]), kind))
        before = now
    df = spark.createDataFrame(data, "source string, item_id long, n long, v string, modified timestamp, at timestamp, gone boolean, note string")
    objects = spark.createDataFrame([("s", "['ItemID']"), ("t", '["item_id"]'), ("u", None), ("w", "oops"), ("x", "")], "object string, keys string")
    keys = snapshot_diff.key_columns(objects, "object", "keys")
    assert keys.count() == 2
    prepared = snapshot_diff.snapshot_rows(df, keys, "source", "at", "gone", "modified", ["item_id", "n", "v"])
    def got(out):
        found = out.collect()
        assert len(found) == len(set(found))
        return {(r["source"], round((r["at"] / 1e6 - T0.timestamp()) / 86400), r["record_key"], r["change"]) for r in found}

    assert got(snapshot_diff.diff_snapshots(prepared)) == expect
    # two keys with one hash are both found
    same = prepared.withColumn("kh", F.when(F.col("record_key").isin("7", "8", "9"), F.lit(5)).otherwise(F.col("kh")))
    assert got(snapshot_diff.diff_snapshots(same)) == expect
    # tables far too small for the differences are enlarged, or their entries summed
    monkeypatch.setattr(snapshot_diff, "PART", 2)
    monkeypatch.setattr(snapshot_diff, "SAMPLE", 1 << 40)
    enlarged = []
    real = snapshot_diff._cells
    monkeypatch.setattr(snapshot_diff, "_cells", lambda x: enlarged.append(1) or real(x))
    assert got(snapshot_diff.diff_snapshots(prepared, 100, 6)) == expect and len(enlarged) > 2
    assert got(snapshot_diff.diff_snapshots(same.withColumn("vh", F.when(F.col("kh") == 5, F.lit(1)).otherwise(F.col("vh"))), 100, 0)) >= {e for e in expect if e[2] not in ("7", "8", "9")}
    assert snapshot_diff.diff_snapshots(prepared.where("false")).count() == 0


def test_hashes_agree_with_spark(spark):
    from lakeplane.operators.xx64 import hash_longs

    pairs = [(0, 1), (-5, 2**62), (-(2**63), 7)]
    got = spark.createDataFrame(pairs, "a long, b long").select(F.xxhash64("a", "b", F.lit(3))).collect()
    assert [r[0] for r in got] == hash_longs([np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])], 3).tolist()
