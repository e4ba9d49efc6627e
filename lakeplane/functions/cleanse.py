"""Cleanse functions: a registry of expressions over one column, applied in order.

A function maps (column, its type, parameters) to a column. All functions of a rule set end up in one projection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from lakeplane.functions import masks

Cleanse = Callable[[Column, DataType, Mapping[str, object]], Column]
REGISTRY: dict[str, Cleanse] = {}


def cleanse(*names: str) -> Callable[[Cleanse], Cleanse]:
    def register(fn: Cleanse) -> Cleanse:
        REGISTRY.update(dict.fromkeys(names, fn))
        return fn

    return register


def _text(column: Column) -> Column:
    return column.cast("string")


@cleanse("trim")
def trim(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    return F.trim(_text(column))


@cleanse("normalize_text")
def normalize_text(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    """Trim blanks, then collapse white space, then change case, then take empty for null."""
    out = F.trim(_text(column))
    if p.get("collapse_spaces", True):
        out = F.regexp_replace(out, r"\s+", " ")
    out = {"lower": F.lower, "upper": F.upper, "title": F.initcap}.get(p.get("case"), lambda c: c)(out)
    return F.nullif(out, F.lit("")) if p.get("empty_as_null", True) else out


@cleanse("fill_nulls")
def fill_nulls(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    """The default takes the column's type; one that doesn't fit is a configuration error, found before any row is read."""
    default = p.get("default", p.get("value"))
    return F.coalesce(column, F.lit(default).try_cast(kind) if not isinstance(kind, StringType) else F.lit(default).cast("string"))


@cleanse("parse_datetime")
def parse_datetime(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    """The first of the formats that reads the text; null if none does."""
    date = p.get("target_type", "date") == "date"
    parsed = [F.try_to_timestamp(_text(column), F.lit(f)) for f in p.get("formats", ["yyyy-MM-dd"])]
    first = F.coalesce(*parsed)
    return first.cast("date") if date else first


@cleanse("to_upper")
def to_upper(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    return F.upper(_text(column))


@cleanse("to_lower")
def to_lower(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    return F.lower(_text(column))


@cleanse("to_title")
def to_title(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    return F.initcap(_text(column))


@cleanse("replace")
def replace(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    return F.regexp_replace(_text(column), str(p.get("pattern", "")), str(p.get("replacement", "")))


@cleanse("mask")
def mask(column: Column, kind: DataType, p: Mapping[str, object]) -> Column:
    style = p.get("style", "redact")
    if style == "hash":
        return masks.hashed(column)
    if style == "partial":
        return masks.keep_last(column, int(p.get("keep", 4)), str(p.get("prefix", "***")), int(p.get("min_len", 0)))
    return masks.redact(str(p.get("replacement", "***")))


def apply_cleansing(df: DataFrame, rules: Iterable[Mapping[str, object]], keys: Sequence[str] = ()) -> DataFrame:
    """Apply rules (function, columns, parameters_json, apply_order) in order; equal orders keep theirs.

    Unknown functions and columns are errors, and so is a rule on a key column: keys are compared between loads.
    """
    for rule in sorted(rules, key=lambda r: r.get("apply_order") or 0):
        name = rule["function"]
        if name not in REGISTRY:
            raise ValueError(f"unknown cleanse function {name!r}; known: {sorted(REGISTRY)}")
        p = json.loads(rule.get("parameters_json") or "{}")
        columns = [c.strip() for c in str(rule.get("columns") or "").split(";") if c.strip()]
        if wrong := [c for c in columns if c not in df.columns]:
            raise ValueError(f"cleanse rule {rule.get('rule_id')!r} names columns that do not exist: {wrong}")
        if locked := [c for c in columns if c in keys]:
            raise ValueError(f"cleanse rule {rule.get('rule_id')!r} changes key columns: {locked}")
        into = p.get("into")
        df = df.withColumns({(into or c): REGISTRY[name](F.col(f"`{c}`"), df.schema[c].dataType, p) for c in columns})
    return df
