"""Catalogue discovery: candidates for new objects, and drift of source columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplane.operators.upsert import same_key

Discover = Callable[[Mapping[str, object]], list[dict[str, object]]]
DISCOVERERS: dict[str, Discover] = {}


def discoverer(*names: str) -> Callable[[Discover], Discover]:
    def register(fn: Discover) -> Discover:
        DISCOVERERS.update(dict.fromkeys(names, fn))
        return fn

    return register


def discover(source: Mapping[str, object]) -> list[dict[str, object]] | None:
    """Candidates of a source, or none if its type can't be asked."""
    fn = DISCOVERERS.get(str(source.get("connector") or source.get("source_type") or "").lower())
    return fn(source) if fn else None


@discoverer("statcan_wds", "statcan")
def declared_tables(source: Mapping[str, object]) -> list[dict[str, object]]:
    """One object per table id that the connection declares."""
    ids = json.loads(str(source.get("connection_json") or "{}")).get("table_id") or []
    # The key of these tables.
    return [{"source_schema": None, "source_table": str(i), "key_columns": ["REF_DATE", "VECTOR"]} for i in ([ids] if isinstance(ids, (str, int)) else ids)]


# Catalogue queries by dialect; each gives schema, table and, for the second, key column and ordinal.
SYSTEM = {"ansi": "('information_schema', 'pg_catalog', 'mysql', 'performance_schema', 'sys')", "oracle": "('SYS', 'SYSTEM', 'XDB', 'MDSYS', 'CTXSYS', 'OUTLN', 'DBSNMP')"}
CATALOG = {
    "sqlserver": (
        "SELECT TABLE_SCHEMA AS t_s, TABLE_NAME AS t_n FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = 'BASE TABLE'",
        "SELECT k.TABLE_SCHEMA AS t_s, k.TABLE_NAME AS t_n, k.COLUMN_NAME AS c_n, k.ORDINAL_POSITION AS ord FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS c JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k ON k.CONSTRAINT_NAME = c.CONSTRAINT_NAME AND k.TABLE_SCHEMA = c.TABLE_SCHEMA WHERE c.CONSTRAINT_TYPE = 'PRIMARY KEY'",
    ),
    "ansi": (
        f"SELECT table_schema AS t_s, table_name AS t_n FROM information_schema.tables WHERE table_type = 'BASE TABLE' AND table_schema NOT IN {SYSTEM['ansi']}",
        f"SELECT k.table_schema AS t_s, k.table_name AS t_n, k.column_name AS c_n, k.ordinal_position AS ord FROM information_schema.table_constraints c JOIN information_schema.key_column_usage k ON k.constraint_name = c.constraint_name AND k.table_schema = c.table_schema AND k.table_name = c.table_name WHERE c.constraint_type = 'PRIMARY KEY' AND k.table_schema NOT IN {SYSTEM['ansi']}",
    ),
    "oracle": (
        f"SELECT owner AS t_s, table_name AS t_n FROM all_tables WHERE owner NOT IN {SYSTEM['oracle']}",
        f"SELECT k.owner AS t_s, k.table_name AS t_n, k.column_name AS c_n, k.position AS ord FROM all_constraints c JOIN all_cons_columns k ON k.owner = c.owner AND k.constraint_name = c.constraint_name WHERE c.constraint_type = 'P' AND k.owner NOT IN {SYSTEM['oracle']}",
    ),
    "db2": (
        "SELECT tabschema AS t_s, tabname AS t_n FROM syscat.tables WHERE type = 'T' AND tabschema NOT LIKE 'SYS%'",
        "SELECT k.tabschema AS t_s, k.tabname AS t_n, k.colname AS c_n, k.colseq AS ord FROM syscat.tabconst c JOIN syscat.keycoluse k ON k.constname = c.constname AND k.tabschema = c.tabschema AND k.tabname = c.tabname WHERE c.type = 'P'",
    ),
}


def catalog_discoverer(dialect: str, run: Callable[[Mapping[str, object], str], DataFrame]) -> Discover:
    """A discoverer that asks a database's catalogue through ``run(source, sql)``."""

    def fn(source: Mapping[str, object]) -> list[dict[str, object]]:
        tables, keys = (run(source, sql) for sql in CATALOG[dialect])
        return [{"source_schema": r["t_s"], "source_table": r["t_n"], "key_columns": r["key_columns"]} for r in candidates(tables, keys).collect()]

    return fn


def candidates(tables: DataFrame, keys: DataFrame) -> DataFrame:
    """t_s, t_n, key_columns of each table, the key's columns by ordinal; names of the catalogue in any case."""
    low = lambda df: df.toDF(*[c.lower() for c in df.columns])
    by_table = low(keys).groupBy("t_s", "t_n").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "c_n"))), lambda k: k["c_n"]).alias("key_columns"))
    none = F.array().cast("array<string>")
    return low(tables).select("t_s", "t_n").distinct().join(by_table, ["t_s", "t_n"], "left").withColumn("key_columns", F.coalesce("key_columns", none))


def new_candidates(found: DataFrame, registered: DataFrame) -> DataFrame:
    """Found (source_id, source_schema, source_table) that aren't registered; schemas may be null."""
    keys = ["source_id", "source_schema", "source_table"]
    return found.alias("f").join(registered.alias("r"), same_key("f", "r", keys), "left_anti")


def snapshot_drift(previous: DataFrame, now: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Drift events (object_id, column_name, drift_type, severity) of active columns against a new snapshot.

    An object without a previous snapshot has no events. Names compare exactly.
    """
    old = previous.where("is_active").select("object_id", "column_name", F.lit(True).alias("was"))
    seen = previous.select("object_id").distinct()
    both = old.join(now.select("object_id", "column_name", F.lit(True).alias("is_")), ["object_id", "column_name"], "full_outer").join(seen, "object_id", "left_semi")
    kind = F.when(F.col("was").isNull(), "COLUMN_ADDED").when(F.col("is_").isNull(), "COLUMN_REMOVED")
    out = both.withColumn("drift_type", kind).where(F.col("drift_type").isNotNull())
    return out.select(F.concat_ws("_", F.lit(run_id), "object_id", "column_name").alias("event_id"), F.lit(run_id).alias("run_id"), "object_id", "column_name", "drift_type", F.when(F.col("drift_type") == "COLUMN_ADDED", "info").otherwise("warning").alias("severity"), F.lit("{}").alias("details"), F.lit(at).alias("detected_at"))


def merge_snapshot(previous: DataFrame, now: DataFrame, at: datetime) -> DataFrame:
    """The column catalogue after a snapshot: columns that went are inactive, so that they are reported once."""
    fresh = now.select("object_id", "column_name", "source_data_type", F.lit(at).alias("discovered_at"), F.lit(True).alias("is_active"))
    gone = previous.alias("p").join(fresh.alias("n"), same_key("p", "n", ["object_id", "column_name"]), "left_anti")
    asked = now.select("object_id").distinct().withColumn("_asked", F.lit(True))
    gone = gone.join(asked, "object_id", "left").withColumn("is_active", F.col("is_active") & F.col("_asked").isNull()).drop("_asked")
    return fresh.unionByName(gone.select(*fresh.columns))


def rename_suspects(events: Iterable[Mapping[str, object]], types: Mapping[tuple[str, str], str]) -> list[tuple[str, str, str]]:
    """(object, old, new) where exactly one column went and one of the same type came; a person has to confirm it."""
    by_object: dict[str, dict[str, list[str]]] = {}
    for e in events:
        by_object.setdefault(str(e["object_id"]), {}).setdefault(str(e["drift_type"]), []).append(str(e["column_name"]))
    pairs = [(o, e["COLUMN_REMOVED"][0], e["COLUMN_ADDED"][0]) for o, e in sorted(by_object.items()) if len(e.get("COLUMN_REMOVED", [])) == len(e.get("COLUMN_ADDED", [])) == 1]
    return [(o, a, b) for o, a, b in pairs if types.get((o, a)) == types.get((o, b))]
