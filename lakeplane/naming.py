"""Names of landed tables and columns."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from datetime import UTC, datetime

_HUMPS = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])", re.DOTALL)


def utc_now() -> datetime:
    """The time in UTC, without a zone."""
    return datetime.now(UTC).replace(tzinfo=None)


def snake(name: object) -> str:
    """``SalesOrderID`` to ``sales_order_id``."""
    return _HUMPS.sub("_", str(name)).lower()


def ident(text: object) -> str:
    """Lower case letters and digits, with single underscores in between."""
    return "_".join(re.findall(r"[a-z0-9]+", ("" if text is None else str(text)).lower()))


def unique_names(names: Iterable[str]) -> list[str]:
    """Names in their order; what was there already gets the first free ``_2``, ``_3``, ..."""
    out: dict[str, None] = {}
    for name in names:
        free, n = name, 1
        while free in out:
            n += 1
            free = f"{name}_{n}"
        out[free] = None
    return list(out)


def sanitised(headers: Iterable[object]) -> list[str]:
    """Headers as column names: other characters become underscores, empty ones ``col0``, ``col1``, ..., all unique."""
    return unique_names(re.sub(r"[^A-Za-z0-9_]", "_", str(h)).strip("_") or f"col{i}" for i, h in enumerate(headers))


def physical_names(columns: Iterable[str]) -> list[str]:
    return unique_names(snake(c) for c in columns)


def landed_table(source: Mapping[str, object]) -> tuple[str, str]:
    """(schema, table) of a source object; ``source_options_json.landed`` overrides both."""
    schema = ident(source.get("source_name")) or "dbo"
    try:
        landed = (json.loads(source.get("source_options_json") or "{}") or {}).get("landed")
    except (ValueError, TypeError, AttributeError):
        landed = None
    if isinstance(landed, str):
        landed = {"table": landed}
    if landed and landed.get("table"):
        return ident(landed.get("schema")) or schema, ident(landed["table"])
    parts = [source.get("source_schema") or "dbo", source.get("source_table"), source.get("suffix")]
    return schema, "_".join(ident(p) for p in parts if p)


def quoted(name: str) -> str:
    """A name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"
