"""Declared security as views: visible columns, row predicates and masks per role."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplane.functions.masks import dynamic

# Fixed value: the layers' physical names.
LAYERS = {"config": "config", "bronze": "bronze", "silver": "silver", "gold": "gold"}
Policy = Mapping[str, object]


def members(policy: Policy) -> list[dict[str, str]]:
    """Members of a policy; a bare id is a group."""
    found = json.loads(str(policy.get("members_json") or "[]"))
    return [m if isinstance(m, dict) else {"id": str(m), "type": "Group"} for m in ([found] if isinstance(found, (str, dict)) else found)]


def by_method(policies: Iterable[Policy]) -> list[Policy]:
    return sorted(policies, key=lambda p: (str(p.get("method") or ""), str(p.get("policy_id") or "")))


def names(policy: Policy) -> list[str]:
    return [c.strip() for c in str(policy.get("columns") or "").replace(",", ";").split(";") if c.strip()]


def predicate(policy: Policy) -> str:
    """The condition of a row policy, which may be written as a whole SELECT."""
    text = str(policy.get("predicate") or "true").strip()
    low = text.lower()
    return text[low.index(" where ") + 7 :] if low.startswith("select") and " where " in low else ("true" if low.startswith("select") else text)


def secure(df: DataFrame, policies: Iterable[Policy], role: str) -> DataFrame:
    """What a role may see of a table: rows that all its row policies admit, masked, in the columns that it may see.

    Predicates see the unmasked rows and every column. Policies without a role hold for all. A column that is masked twice
    takes the first mask. A policy that names a missing column is an error.
    """
    mine = [p for p in by_method(policies) if p.get("is_active", True) and p.get("role_name") in (None, "", role)]
    visible, masks = list(df.columns), {}
    for p in mine:
        method = str(p.get("method") or "").upper()
        if missing := [c for c in names(p) if c not in df.columns]:
            raise ValueError(f"policy {p.get('policy_id')!r} names columns that do not exist: {missing}")
        if method == "CLS":
            visible = [c for c in visible if c in names(p)]
        elif method == "RLS":
            df = df.where(F.expr(predicate(p)))
        elif method == "DDM":
            for c in names(p):
                masks.setdefault(c, dynamic(str(p.get("mask_function") or "default()"), F.col(f"`{c}`"), df.schema[c].dataType))
        else:
            raise ValueError(f"policy {p.get('policy_id')!r}: unknown method {method!r}")
    return df.select(*[masks[c].alias(c) if c in masks else F.col(f"`{c}`") for c in visible])


def upsert_roles(existing: Iterable[Mapping[str, object]], wanted: Iterable[Mapping[str, object]]) -> list[Mapping[str, object]]:
    """Roles by name, wanted ones replacing those they name; others stay."""
    return list(({str(r["name"]): r for r in existing} | {str(r["name"]): r for r in wanted}).values())


def create_views(spark_frames: Mapping[str, DataFrame], policies: Iterable[Policy], role: str) -> None:
    """A temporary view per table, as the role may see it; gold tables of a spoke are read-only views like these."""
    policies = list(policies)
    for table, df in spark_frames.items():
        secure(df, [p for p in policies if p.get("target_table") == table], role).createOrReplaceTempView(table)
