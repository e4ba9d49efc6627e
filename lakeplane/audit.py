"""Control tables: runs, loads, watermarks, drift, rule results, parity, errors, files and renamed columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplane.naming import utc_now
from lakeplane.operators.upsert import upsert
from lakeplane.storage import TableStore

# The control tables.
SCHEMAS = {
    "ingestion_run": "run_id string, run_started_at timestamp, run_completed_at timestamp, status string, details string",
    "object_load_run": "run_id string, object_id string, layer string, status string, source_count long, target_count long, quarantine_count long, started_at timestamp, ended_at timestamp, details string",
    "watermark_state": "object_id string, watermark_value string, updated_at timestamp",
    "schema_drift_event": "event_id string, run_id string, object_id string, column_name string, drift_type string, severity string, details string, detected_at timestamp",
    "dq_result": "run_id string, object_id string, rule_id string, failed_count long, passed_count long, status string, evaluated_at timestamp",
    "parity_result": "run_id string, object_id string, check_scope string, check_name string, source_value string, target_value string, status string, checked_at timestamp",
    "pipeline_run_log": "pipeline_name string, run_id string, load_group int, activity string, message string, logged_at timestamp",
    "dropbox_ledger": "file_key string, content_hash string, schema_name string, object_count int, status string, processed_at timestamp",
    "column_map": "object_id string, landed_schema string, landed_table string, physical_col string, original_col string, updated_at timestamp",
    "source_column": "object_id string, column_name string, source_data_type string, discovered_at timestamp, is_active boolean",
}
LAYER = "config"
#: Fixed value: longest logged message.
MESSAGE = 4000


class Audit:
    def __init__(self, store: TableStore):
        self.store = store

    def frame(self, table: str, rows: Iterable[Mapping[str, object]]) -> DataFrame:
        names = [c.split()[0] for c in SCHEMAS[table].split(", ")]
        text = lambda v: json.dumps(v, default=str) if isinstance(v, (dict, list)) else v
        return self.store.spark.createDataFrame([tuple(text(r.get(n)) for n in names) for r in rows], SCHEMAS[table])

    def append(self, table: str, rows: Iterable[Mapping[str, object]]) -> None:
        rows = list(rows)
        if rows:
            self.store.write(self.frame(table, rows).coalesce(1), LAYER, table, mode="append")

    def read(self, table: str) -> DataFrame:
        return self.store.read(LAYER, table) if self.store.exists(LAYER, table) else self.frame(table, [])

    def create_tables(self) -> None:
        """Empty control tables where there are none; a writer that comes first is welcome."""
        from lakeplane.storage import Conflict

        for table in SCHEMAS:
            if not self.store.exists(LAYER, table):
                try:
                    self.store.write(self.frame(table, []), LAYER, table, base=-1)
                except Conflict:
                    continue

    # --- runs

    def start_run(self, run_id: str, details: object = None) -> None:
        self.append("ingestion_run", [{"run_id": run_id, "run_started_at": utc_now(), "status": "RUNNING", "details": details}])

    def finish_run(self, run_id: str, status: str = "SUCCEEDED", details: object = None) -> None:
        self.append("ingestion_run", [{"run_id": run_id, "run_completed_at": utc_now(), "status": status, "details": details}])

    def log_load(self, run_id: str, object_id: str, layer: str, status: str, source: int | None = None, target: int | None = None, quarantine: int | None = None, started: datetime | None = None, details: object = None) -> None:
        self.append("object_load_run", [{"run_id": run_id, "object_id": object_id, "layer": layer, "status": status, "source_count": source, "target_count": target, "quarantine_count": quarantine, "started_at": started, "ended_at": utc_now(), "details": details}])

    def log_failure(self, pipeline: str, run_id: str, load_group: int, activity: str, error: object) -> None:
        self.append("pipeline_run_log", [{"pipeline_name": pipeline, "run_id": run_id, "load_group": load_group, "activity": activity, "message": str(error)[:MESSAGE], "logged_at": utc_now()}])

    # --- watermarks

    def watermark(self, object_id: str) -> str | None:
        row = latest_watermarks(self.read("watermark_state")).where(F.col("object_id") == object_id).first()
        return row["watermark_value"] if row else None

    def set_watermark(self, object_id: str, value: object) -> None:
        if value is not None:
            self.append("watermark_state", [{"object_id": object_id, "watermark_value": str(value), "updated_at": utc_now()}])

    # --- renamed columns

    def record_column_map(self, object_id: str, schema: str, table: str, pairs: Iterable[tuple[str, str]]) -> None:
        """Original names of the columns whose landed name differs."""
        rows = [{"object_id": object_id, "landed_schema": schema, "landed_table": table, "physical_col": p, "original_col": o, "updated_at": utc_now()} for p, o in pairs if p != o]
        if rows:
            new = self.frame("column_map", rows)
            self.store.update(LAYER, "column_map", lambda old: upsert(old, new, ["object_id", "physical_col"]))

    def headers(self, schema: str, table: str) -> dict[str, str]:
        """Landed to original names of one table, by schema and table."""
        rows = self.read("column_map").where((F.col("landed_schema") == schema) & (F.col("landed_table") == table)).select("physical_col", "original_col").collect()
        return {r[0]: r[1] for r in rows}


def latest_watermarks(state: DataFrame) -> DataFrame:
    """object_id, watermark_value: the value that was set last."""
    return state.groupBy("object_id").agg(F.max_by("watermark_value", F.struct("updated_at", "watermark_value")).alias("watermark_value"))
