"""Catalogue discovery of databases: each dialect's catalogue is asked through the connector's own connection."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeplane.operators import discovery
from lakeplane.sources.registry import extract

#: Connectors by the dialect of their catalogue.
DIALECTS = {"sqlserver": ("sqlserver",), "ansi": ("postgresql", "mysql", "jdbc", "odbc"), "oracle": ("oracle",), "db2": ("db2",)}


def ask(source: Mapping[str, object], sql: str) -> DataFrame:
    """The rows of a query, read by the source's connector as those of any object are."""
    opts = json.loads(str(source.get("source_options_json") or "{}")) | {"query": sql}
    return extract(SparkSession.active(), {**source, "source_options_json": json.dumps(opts)})


def register(run: Callable[[Mapping[str, object], str], DataFrame] = ask) -> None:
    for dialect, names in DIALECTS.items():
        discovery.discoverer(*names)(discovery.catalog_discoverer(dialect, run))


register()
