"""Hashes of rows and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The separator and null marker of stored row hashes, and the separator of surrogate keys.
SEPARATOR, NULL_MARK, KEY_SEPARATOR = "||", "<NULL>", "|"


def business_columns(df: DataFrame) -> list[str]:
    """Columns that aren't control columns; these begin with an underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the columns' text, as stored tables have it. A value that holds the separator can collide."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts) if parts else F.lit(""), 256)


def row_hash_v2(columns: Iterable[str]) -> Column:
    """SHA-256 of length-prefixed values: no two different rows have the same text."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.sha2(F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-:")) for t in text]), 256)


def surrogate_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[p.cast("string") for p in parts]), 256)


def with_row_hash(df: DataFrame, columns: Iterable[str] | None = None, out: str = "_row_hash") -> DataFrame:
    return df.withColumn(out, row_hash(business_columns(df) if columns is None else columns))
