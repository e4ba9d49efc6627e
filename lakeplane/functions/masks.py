"""Masks: static ones that are stored, and dynamic ones for views."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, TimestampType


def redact(replacement: str = "***") -> Column:
    return F.lit(replacement)


def hashed(column: Column) -> Column:
    return F.sha2(column.cast("string"), 256)


def keep_last(column: Column, keep: int = 4, prefix: str = "***", least: int = 0) -> Column:
    """The prefix and the last characters. Values shorter than ``least`` show nothing; null stays null."""
    text = column.cast("string")
    shown = F.right(text, F.lit(keep)) if keep > 0 else F.lit("")
    tail = F.when(F.length(text) >= least, shown).otherwise("") if least else shown
    return F.when(text.isNotNull(), F.concat(F.lit(prefix), tail))


def dynamic(function: str, column: Column, kind: DataType) -> Column:
    """Column under a mask function: ``email()``, ``default()`` or ``partial(first, "padding", last)``."""
    name, _, inner = function.strip().partition("(")
    if name == "email":
        return F.when(column.isNotNull(), F.concat(F.left(column.cast("string"), F.lit(1)), F.lit("XXX@XXXX.com")))
    if name == "default":
        if isinstance(kind, NumericType):
            return F.when(column.isNotNull(), F.lit(0).cast(kind))
        if isinstance(kind, BooleanType):
            return F.when(column.isNotNull(), F.lit(False))
        if isinstance(kind, (DateType, TimestampType)):
            return F.when(column.isNotNull(), F.lit("1900-01-01").cast(kind))
        return F.when(column.isNotNull(), F.lit("xxxx"))
    if name == "partial" and (m := re.fullmatch(r"\s*(\d+)\s*,\s*[\"'](.*)[\"']\s*,\s*(\d+)\s*\)", inner)):
        text, first, last = column.cast("string"), int(m[1]), int(m[3])
        shown = F.concat(F.left(text, F.lit(first)), F.lit(m[2]), F.right(text, F.lit(last)))
        return F.when(F.length(text) > first + last, shown).when(text.isNotNull(), F.lit(m[2]))
    raise ValueError(f"unknown mask function {function!r}")
