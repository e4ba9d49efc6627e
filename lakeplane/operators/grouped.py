"""Prefix sums, ranks and neighbours inside groups of any size.

A window sorts each group in one task. Where one group may hold a third of all rows, these helpers cut groups into
chunks that follow the wanted order, solve each chunk, and carry totals (or the last row) from chunk to chunk. The
number of chunks comes from the measured size of the largest group, so small groups cost no extra join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.scratch import cut

#: Rows of a group that one task may sort.
CHUNK_ROWS = 500_000
#: Most chunks of a group, and most large groups whose chunk borders are sent to every executor.
CHUNKS, BROADCAST_GROUPS = 2_000, 500


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def hash_chunk(keys: Sequence[str], chunks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(chunks)) if chunks > 1 else F.lit(0).cast("long")


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str], chunk: str | None = None) -> DataFrame:
    """Add for each new name the sum of a column over the rows of the group that come before.

    ``chunk`` names a column by which the group is cut; the order inside a group is then (chunk, *order). Without it a
    group is one chunk. Rows that tie in ``order`` come in any order.
    """
    before = Window.partitionBy(*keys, *([chunk] if chunk else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumns({new: F.coalesce(F.sum(old).over(before), F.lit(0)) for new, old in sums.items()})
    if not chunk:
        return inner
    totals = df.groupBy(*keys, chunk).agg(*[F.sum(old).alias(f"__{new}") for new, old in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(chunk).alias("__chunk"), *[F.coalesce(F.sum(f"__{new}").over(earlier), F.lit(0)).alias(f"__{new}") for new in sums])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col(chunk) == F.col("__chunk")]
    joined = inner.join(totals, on, "left").withColumns({new: F.col(new) + F.col(f"__{new}") for new in sums})
    return joined.select(*inner.columns)


def time_chunks(df: DataFrame, keys: Sequence[str], at: str, chunk_rows: int | None = None) -> tuple[DataFrame, str | None]:
    """Add a chunk column that follows the long column ``at``, if any group is larger than ``chunk_rows``.

    Chunk borders are approximate quantiles of the largest groups' values, so that a chunk of any group holds about
    ``chunk_rows`` rows or less; equal values of ``at`` stay together.
    """
    size = chunk_rows or CHUNK_ROWS
    top = largest_group(df, keys)
    if top <= size:
        return df, None
    pieces = min(CHUNKS, math.ceil(top / size) * 2)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(at, [i / pieces for i in range(1, pieces)], 10_000).alias("__edges")).where(F.col("__n") > size)
    hot = hot.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__edges")
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    hot = cut(hot)
    side = F.broadcast(hot) if hot.count() <= BROADCAST_GROUPS else hot
    out = df.join(side, on, "left").withColumn("__c", F.coalesce(F.size(F.filter("__edges", lambda e: e < F.col(at))), F.lit(0)).cast("long"))
    return out.select(*df.columns, "__c"), "__c"


def previous_rows(df: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], ties: Sequence[str] = (), chunk_rows: int | None = None) -> DataFrame:
    """Add ``prev``, a struct of ``values`` of the row before in the group by the long column ``at`` and then ``ties``; null at the first."""
    struct = F.struct(*values)
    df, chunk = time_chunks(df, keys, at, chunk_rows)
    if chunk is None:
        return df.withColumn("prev", F.lag(struct).over(Window.partitionBy(*keys).orderBy(at, *ties)))
    inside = df.withColumn("prev", F.lag(struct).over(Window.partitionBy(*keys, chunk).orderBy(at, *ties)))
    ends = df.groupBy(*keys, chunk).agg(F.max_by(struct, F.struct(at, *ties)).alias("__last"))
    ends = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(chunk).alias("__chunk"), F.lag("__last").over(Window.partitionBy(*keys).orderBy(chunk)).alias("__carry"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col(chunk) == F.col("__chunk")]
    return inside.join(ends, on, "left").withColumn("prev", F.coalesce("prev", "__carry")).drop("__carry", "__chunk", chunk, *[f"__k{i}" for i in range(len(keys))])
