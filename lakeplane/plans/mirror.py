"""Mirrored objects: tables that are kept up to date elsewhere in the same layout and are read at a pinned version.

An object with ``ingestion_mode`` mirror names the table in its options: ``{"mirror": {"root": ..., "layer": ..., "schema": ...,
"table": ..., "version": ...}}``. Without a version the newest is taken. One run reads one version, however often its plan is
evaluated and whatever is committed meanwhile; a version that was taken in before is skipped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeplane.sources.registry import options
from lakeplane.storage import TableStore


def is_mirrored(obj: Mapping[str, object]) -> bool:
    return str(obj.get("ingestion_mode") or "").lower() == "mirror" and bool(options(obj).get("mirror"))


def pinned(spark: SparkSession, obj: Mapping[str, object], seen: str | None) -> tuple[int, DataFrame] | None:
    """(version, rows), or nothing if the version is the one taken in last. A table that isn't there is an error."""
    opts = options(obj)["mirror"]
    store, where = TableStore(spark, str(opts["root"])), (str(opts.get("layer", "bronze")), str(opts["table"]), str(opts.get("schema", "dbo")))
    commit = store.commit(*where, version=opts.get("version"))
    if commit is None:
        raise FileNotFoundError(f"the mirrored table {where[2]}.{where[1]} is not there" + (f" at version {opts['version']}" if "version" in opts else ""))
    if seen is not None and int(seen) == commit.version:
        return None
    return commit.version, store.read(*where, version=commit.version)
