"""Connector registry, and the resolution of options, connections and secrets."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Source = Mapping[str, object]
Connector = Callable[[SparkSession, Source], DataFrame]
CONNECTORS: dict[str, Connector] = {}
# Other names of connectors.
ALIASES = {"sql": "sqlserver", "mssql": "sqlserver", "custom_jdbc": "sqlserver", "api": "rest_api", "statcan": "statcan_wds"}


def connector(*names: str) -> Callable[[Connector], Connector]:
    def register(fn: Connector) -> Connector:
        CONNECTORS.update(dict.fromkeys(names, fn))
        return fn

    return register


def resolve(source: Source) -> str:
    """The connector's name: ``connector``, else the source type, else sqlserver."""
    name = str(source.get("connector") or source.get("source_type") or "sqlserver").strip().lower()
    return ALIASES.get(name, name)


def extract(spark: SparkSession, source: Source) -> DataFrame:
    name = resolve(source)
    if name not in CONNECTORS:
        raise ValueError(f"object {source.get('object_id')!r}: no connector {name!r}; known: {sorted(CONNECTORS)}")
    return CONNECTORS[name](spark, source)


def options(source: Source) -> dict[str, object]:
    return json.loads(str(source.get("source_options_json") or "{}")) or {}


def secret(name: str) -> str | None:
    """A secret from the environment (``SECRET_<NAME>``), or a file of that name in the folder ``SECRETS_DIR``."""
    value = os.environ.get("SECRET_" + "".join(c if c.isalnum() else "_" for c in name).upper())
    if value is None and (folder := os.environ.get("SECRETS_DIR")) and (path := Path(folder, name)).is_file():
        value = path.read_text(encoding="utf-8").strip()
    return value


def connection(source: Source) -> dict[str, object]:
    """The secret's fields (text that is no JSON object is a connection string) under those of ``connection_json``."""
    base: dict[str, object] = {}
    text = secret(str(source["secret_name"])) if source.get("secret_name") else None
    if text:
        try:
            parsed = json.loads(text)
        except ValueError:
            parsed = None
        base = parsed if isinstance(parsed, dict) else {"connection_string": text}
    return base | json.loads(str(source.get("connection_json") or "{}"))


def dig(value: object, path: str | None) -> object:
    """Follow a dotted path through objects and lists."""
    for part in filter(None, str(path or "").split(".")):
        value = value[int(part)] if isinstance(value, list) else value[part]
    return value


def onboard(name: str, source_id: int, kind: str, load_group: int, fields: Mapping[str, object]) -> tuple[dict[str, object], str]:
    """(datasource row, secret text) of a new source: what is secret goes into the secret, the rest into the row."""
    hidden = {"password", "client_secret", "connection_string", "token", "user", "username"}
    row = {"source_id": source_id, "source_name": name, "source_type": kind, "load_group": load_group, "ingestion_mode": "copy", "is_active": True, "connector": kind, "connection_json": json.dumps({k: v for k, v in fields.items() if k not in hidden}), "secret_name": "-".join(name.lower().split())}
    return row, json.dumps({k: v for k, v in fields.items() if k in hidden})
