"""Authored configuration: tables of rows in YAML files, validated on load."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from lakeplane.storage import TableStore

# The columns of the authored tables, their types, keys and references.
TABLES = {
    "datasource": "source_id int, source_name string, source_type string, database_name string, load_group int, ingestion_mode string, is_active boolean, connector string, connection_json string, secret_name string",
    "source_object": "object_id string, source_id int, source_schema string, source_table string, target_name string, load_type string, key_columns_json string, watermark_column string, watermark_type string, is_active boolean, processing_state string, source_options_json string, suffix string",
    "dq_rule": "rule_id string, object_id string, column_name string, rule_type string, allowed_values_json string, min_value double, max_value double, rule_expression string, severity string, is_active boolean",
    "cleanse_rule": "rule_id string, object_id string, function string, columns string, parameters_json string, apply_order int, is_active boolean",
    "model": "model_id int, model_name string, load_group int, is_active boolean",
    "gold_object": "gold_object_id string, model_id int, gold_type string, stage_table string, gold_table string, business_key_columns_json string, source_query_notebook string, is_active boolean",
    "gold_dependency": "parent_gold_object_id string, child_gold_object_id string",
    "steps": "load_group int, step_order int, step_key string, child_pipeline string, is_active boolean",
    "security_policy": "policy_id string, method string, lakehouse string, target_schema string, target_table string, columns string, predicate string, members_json string, mask_function string, role_name string, is_active boolean",
    "pbi_dataset": "dataset_id string, load_group int, workspace_id string, dataset_name string, is_active boolean",
}
KEYS = {"datasource": ["source_id"], "source_object": ["object_id"], "dq_rule": ["rule_id"], "cleanse_rule": ["rule_id"], "model": ["model_id"], "gold_object": ["gold_object_id"], "gold_dependency": ["parent_gold_object_id", "child_gold_object_id"], "steps": ["load_group", "step_key"], "security_policy": ["policy_id"], "pbi_dataset": ["dataset_id"]}
REFERENCES = [("source_object", "source_id", "datasource", "source_id"), ("dq_rule", "object_id", "source_object", "object_id"), ("cleanse_rule", "object_id", "source_object", "object_id"), ("gold_object", "model_id", "model", "model_id"), ("gold_dependency", "parent_gold_object_id", "gold_object", "gold_object_id"), ("gold_dependency", "child_gold_object_id", "gold_object", "gold_object_id")]
_TYPES = {"int": int, "string": str, "double": float, "boolean": bool}

Row = dict[str, object]


def columns(table: str) -> dict[str, str]:
    return dict(c.split() for c in TABLES[table].split(", "))


def _value(value: object, kind: str) -> object:
    if value is None:
        return None
    if kind == "boolean":
        return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes")
    if kind == "string" and isinstance(value, (dict, list)):
        return json.dumps(value)
    return _TYPES[kind](value)


class Config:
    """All authored tables. ``is_active`` is true where it isn't given, as are other columns null."""

    def __init__(self, tables: Mapping[str, list[Row]]):
        if unknown := set(tables) - set(TABLES):
            raise ValueError(f"unknown configuration tables: {sorted(unknown)}")
        self.tables: dict[str, list[Row]] = {}
        for name in TABLES:
            kinds = columns(name)
            rows = []
            for row in tables.get(name) or []:
                if extra := set(row) - set(kinds):
                    raise ValueError(f"{name}: unknown columns {sorted(extra)}")
                full = {c: _value(row.get(c), k) for c, k in kinds.items()}
                if "is_active" in kinds and row.get("is_active") is None:
                    full["is_active"] = True
                rows.append(full)
            self.tables[name] = rows
        self._validate()

    def _validate(self) -> None:
        for name, keys in KEYS.items():
            seen = set()
            for row in self.tables[name]:
                key = tuple(row[k] for k in keys)
                if None in key or key in seen:
                    raise ValueError(f"{name}: key {dict(zip(keys, key))} is empty or repeated")
                seen.add(key)
        for child, column, parent, key in REFERENCES:
            known = {r[key] for r in self.tables[parent]}
            if lost := sorted({str(r[column]) for r in self.tables[child] if r[column] is not None and r[column] not in known}):
                raise ValueError(f"{child}.{column} names no {parent}: {lost}")

    @classmethod
    def load(cls, folder: str | Path) -> Config:
        """Read every YAML file of a folder; a file holds one table named like it, or several by name."""
        tables: dict[str, list[Row]] = {}
        for path in sorted(Path(folder).glob("*.y*ml")):
            content = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
            for name, rows in (content if isinstance(content, dict) else {path.stem: content}).items():
                tables.setdefault(name, []).extend(rows or [])
        return cls(tables)

    def dump(self, folder: str | Path) -> None:
        """One file per table, in order of key; nulls are left out and whole numbers written as such."""
        for name, rows in self.tables.items():
            clean = [{c: int(v) if isinstance(v, float) and v.is_integer() else v for c, v in r.items() if v is not None} for r in self.ordered(name)]
            Path(folder, f"{name}.yml").write_text(yaml.safe_dump({name: clean}, sort_keys=False, allow_unicode=True), encoding="utf-8")

    def keep(self, store: TableStore, *names: str) -> None:
        """Put tables into the store, so that what a run registers is there for the next one."""
        for name in names or TABLES:
            store.write(self.frame(store.spark, name), "config", f"authored_{name}")

    @classmethod
    def kept(cls, store: TableStore, authored: Config | None = None) -> Config:
        """The stored tables; rows that are authored by key take the place of stored ones."""
        tables = {}
        for name in TABLES:
            rows = [r.asDict() for r in store.read("config", f"authored_{name}").collect()] if store.exists("config", f"authored_{name}") else []
            key = lambda r: tuple(r[k] for k in KEYS[name])  # noqa: B023, E731
            tables[name] = list(({key(r): r for r in rows} | {key(r): r for r in (authored.tables[name] if authored else [])}).values())
        return cls(tables)

    def ordered(self, name: str) -> list[Row]:
        return sorted(self.tables[name], key=lambda r: [str(r[k]) for k in KEYS[name]])

    def active(self, name: str, **equal: object) -> list[Row]:
        return [r for r in self.tables[name] if r.get("is_active", True) and all(r[k] == v for k, v in equal.items())]

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.createDataFrame([tuple(r.get(c) for c in columns(name)) for r in self.tables[name]], TABLES[name])

    def register_views(self, spark: SparkSession) -> None:
        for name in TABLES:
            self.frame(spark, name).createOrReplaceTempView(f"config_{name}")

    # --- work lists

    def objects(self, load_group: int) -> list[Row]:
        """Active objects of a load group in processing state ACTIVE, with their source's fields, in order of id."""
        sources = {s["source_id"]: s for s in self.active("datasource", load_group=load_group)}
        chosen = [o for o in self.active("source_object") if o["source_id"] in sources and (o["processing_state"] or "ACTIVE").upper() == "ACTIVE"]
        return [sources[o["source_id"]] | o for o in sorted(chosen, key=lambda o: o["object_id"])]

    def models(self, load_group: int) -> list[Row]:
        return sorted(self.active("model", load_group=load_group), key=lambda r: r["model_id"])

    def datasets(self, load_group: int) -> list[Row]:
        return sorted(self.active("pbi_dataset", load_group=load_group), key=lambda r: r["dataset_id"])

    def steps(self, load_group: int) -> dict[str, bool]:
        rows = sorted((r for r in self.tables["steps"] if r["load_group"] == load_group), key=lambda r: r["step_order"] or 0)
        return {r["step_key"]: bool(r["is_active"]) for r in rows}

    def history(self, load_group: int) -> list[Row]:
        """Objects that keep a history: mirrored ones unless it is off, others only where it is on."""
        out = []
        for o in self.objects(load_group):
            options = json.loads(o.get("source_options_json") or "{}") or {}
            wanted = options.get("history")
            if wanted is True or str(wanted).lower() == "on" or (wanted is None and (o.get("ingestion_mode") or "").lower() == "mirror"):
                out.append(o)
        return out
