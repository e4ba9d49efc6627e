"""References to records that do not exist: a ledger of signed reference and existence counts per key.

Each change to a referring or a referred table is a delta with a sign. The ledger holds per (ref_column, key) the sum of
the referring rows, the sum of the existing rows and the few bounds that time-dependent kinds need; keys with positive
references and zero existence are the current orphans. A delta is pre-aggregated before it is shuffled, so a key that a
third of all rows refers to costs one row per task.

Nulls: a null key refers to nothing. A row without a date can only be ``missing``. Empty tables give an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplane.scratch import cut, stored_bytes

LEDGER = "ref_column string, key long, refs long, present long, first_ref timestamp, last_ref timestamp, valid_from timestamp, deleted_at timestamp"
#: Largest table of suspicious keys, in bytes on disk, that is sent to every executor.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class Reference:
    """A referring column and the dimension it points to."""

    column: str
    dimension: str
    valid_from: str | None = None
    deleted: str | None = None
    deleted_at: str | None = None


def reference_delta(rows: DataFrame, columns: list[str], at: str, sign: int = 1) -> DataFrame:
    """Signed counts of the rows that refer to each key."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("ref_column"), F.col(c).cast("long").alias("key")) for c in columns]))
    long = rows.select(F.col(at).alias("at"), pairs.alias("p")).select("at", "p.*").where(F.col("key").isNotNull())
    return long.groupBy("ref_column", "key").agg(F.sum(F.lit(sign)).cast("long").alias("refs"), F.lit(0).cast("long").alias("present"), F.min("at").alias("first_ref"), F.max("at").alias("last_ref"), F.lit(None).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("deleted_at"))


def existence_delta(rows: DataFrame, reference: Reference, sign: int = 1) -> DataFrame:
    """Signed counts of the rows that give each key, with the time from which it is valid and that of its deletion."""
    none = F.lit(None).cast("timestamp")
    start = F.min(reference.valid_from) if reference.valid_from else none
    gone = F.min(F.when(F.col(reference.deleted), F.col(reference.deleted_at))) if reference.deleted else none
    return rows.where(F.col(reference.column).isNotNull()).groupBy(F.lit(reference.column).alias("ref_column"), F.col(reference.column).cast("long").alias("key")).agg(F.lit(0).cast("long").alias("refs"), F.sum(F.lit(sign)).cast("long").alias("present"), none.alias("first_ref"), none.alias("last_ref"), start.alias("valid_from"), gone.alias("deleted_at"))


def merge_ledger(*parts: DataFrame) -> DataFrame:
    """Add ledgers and deltas. Counts add up; bounds only widen, so after removals they may be wider than needed."""
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy("ref_column", "key").agg(F.sum("refs").alias("refs"), F.sum("present").alias("present"), F.min("first_ref").alias("first_ref"), F.max("last_ref").alias("last_ref"), F.min("valid_from").alias("valid_from"), F.min("deleted_at").alias("deleted_at")).where((F.col("refs") != 0) | (F.col("present") != 0))


def orphans(ledger: DataFrame) -> DataFrame:
    """Keys with references and no record."""
    return ledger.where((F.col("refs") > 0) & (F.col("present") <= 0)).select("ref_column", "key", "refs")


def suspects(ledger: DataFrame) -> DataFrame:
    """Orphans, and keys that some reference uses before they are valid or after they were deleted."""
    late = F.col("first_ref") < F.col("valid_from")
    deleted = F.col("last_ref") >= F.col("deleted_at")
    return ledger.where((F.col("refs") > 0) & ((F.col("present") <= 0) | F.coalesce(late, F.lit(False)) | F.coalesce(deleted, F.lit(False)))).select("ref_column", "key", (F.col("present") <= 0).alias("missing"), "valid_from", "deleted_at")


def find_bad_references(rows: DataFrame, row_key: list[str], at: str, bad: DataFrame, columns: list[str]) -> DataFrame:
    """row_key, at, ref_column, kind of every referring row whose key is bad at the row's time; repeated rows count once.

    ``bad`` is a table written by ``cut``. Only while its size is below ``BROADCAST_BYTES`` it goes to every executor
    and the rows are not shuffled by key; beyond that the rows are joined by shuffle, and adaptive execution splits hot
    keys.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("ref_column"), F.col(c).cast("long").alias("key")) for c in columns]))
    long = rows.select(*row_key, F.col(at).alias("at"), pairs.alias("p")).select(*row_key, "at", "p.*").where(F.col("key").isNotNull())
    side = F.broadcast(bad) if stored_bytes(bad) <= BROADCAST_BYTES else bad
    kind = F.when(F.col("missing"), "missing").when(F.col("at") < F.col("valid_from"), "late").when(F.col("at") >= F.col("deleted_at"), "deleted")
    found = long.join(side, ["ref_column", "key"]).withColumn("kind", kind).where(F.col("kind").isNotNull())
    return found.select(*row_key, "at", "ref_column", "kind").distinct()


def check_references(rows: DataFrame, row_key: list[str], at: str, references: list[Reference], dimensions: dict[str, DataFrame]) -> DataFrame:
    """The whole way over full tables: one delta per table, the ledger, its suspects, and the rows that use them."""
    columns = [r.column for r in references]
    deltas = [reference_delta(rows, columns, at), *[existence_delta(dimensions[r.dimension], r) for r in references]]
    return find_bad_references(rows, row_key, at, cut(suspects(merge_ledger(*deltas))), columns)


def report(found: DataFrame) -> DataFrame:
    """Rows with a bad reference per column, kind and month; month is null where the row has no date."""
    return found.groupBy("ref_column", "kind", F.date_format("at", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n_lines"))
