"""History of changing attributes from snapshots or updates, by presence bitmaps.

Each entity has a time line of the points at which its state was reported. For every entity and attribute hash one bit is
set per point at which that state held, in words of ``WORD`` bits; runs of consecutive bits are the versions, and gaps
(another state in between) end a run by themselves. Words are aggregated with ``bit_or`` before the shuffle, and only runs,
not points, are carried on. Points are numbered by chunked ranks, so one entity may hold any share of the rows.

Of reports for the same entity and point the one with the latest ``staged_at`` counts (of equal ones that with the
greatest attribute hash). Attributes compare null-safe. Rows with a null entity or a null point are ignored. Empty input
gives no versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeplane.operators.grouped import prefix_sums, time_chunks
from lakeplane.scratch import cut

WORD = 32


def attribute_hash(columns: Sequence[str]) -> Column:
    """128 bits over all attributes; null differs from every value, and field borders count."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", *parts), 256)), 1, 16)


def _bits(word: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("shiftrightunsigned", word, i).bitwiseAND(F.lit(1).cast("long")) == 1)


def versions(reports: DataFrame, entity: str, start: str, staged_at: str, attributes: Sequence[str], chunk_rows: int | None = None) -> DataFrame:
    """entity, start_us, end_us, *attributes, is_current: one row per version; end_us is null for the current one."""
    at = F.unix_micros(start)
    rows = reports.where(F.col(entity).isNotNull() & F.col(start).isNotNull()).select(F.col(entity).alias("entity"), at.alias("at"), F.struct(F.unix_micros(staged_at).alias("staged"), attribute_hash(attributes).alias("state")).alias("rank"), F.struct(*attributes).alias("attrs"))
    points = cut(rows.groupBy("entity", "at").agg(F.max_by(F.struct("rank.state", "attrs"), "rank").alias("v")).select("entity", "at", F.col("v.state").alias("state"), F.col("v.attrs").alias("attrs")))
    chunked, chunk = time_chunks(points.select("entity", "at", "state"), ["entity"], "at", chunk_rows)
    numbered = cut(prefix_sums(chunked.withColumn("one", F.lit(1)), ["entity"], ["at"], {"n": "one"}, chunk).select("entity", "at", "state", F.col("n").cast("long").alias("n")))

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("n") % WORD).cast("int"))
    words = cut(numbered.groupBy("entity", "state", F.expr(f"n div {WORD}").alias("w")).agg(F.bit_or(bit).alias("bits")))
    last, first = F.lit(1 << (WORD - 1)).cast("long"), F.lit(1).cast("long")
    full = F.lit((1 << WORD) - 1).cast("long")
    # only words whose outer bits are set can go on in a neighbour
    left = words.where(F.col("bits").bitwiseAND(last) != 0).select("entity", "state", (F.col("w") + 1).alias("w"), first.alias("carry_in"))
    right = words.where(F.col("bits").bitwiseAND(first) != 0).select("entity", "state", (F.col("w") - 1).alias("w"), last.alias("carry_out"))
    edged = words.join(left, ["entity", "state", "w"], "left").join(right, ["entity", "state", "w"], "left")
    zero = F.lit(0).cast("long")
    before = F.shiftleft("bits", 1).bitwiseAND(full).bitwiseOR(F.coalesce("carry_in", zero))
    after = F.shiftrightunsigned("bits", 1).bitwiseOR(F.coalesce("carry_out", zero))
    edged = cut(edged.select("entity", "state", "w", F.col("bits").bitwiseAND(F.bitwise_not(before)).alias("begins"), F.col("bits").bitwiseAND(F.bitwise_not(after)).alias("ends")).where((F.col("begins") != 0) | (F.col("ends") != 0)))
    counted = edged.withColumns({"nb": F.bit_count("begins"), "ne": F.bit_count("ends")})
    counted, wchunk = time_chunks(counted, ["entity", "state"], "w", chunk_rows)
    counted = cut(prefix_sums(counted, ["entity", "state"], ["w"], {"b0": "nb", "e0": "ne"}, wchunk))

    def edges(bits: str, base: str, out: str) -> DataFrame:
        each = counted.select("entity", "state", "w", base, F.posexplode(_bits(F.col(bits))).alias("i", "pos"))
        return each.select("entity", "state", (F.col(base) + F.col("i")).alias("run"), (F.col("w") * WORD + F.col("pos")).alias(out))

    # the k-th begin and the k-th end of an entity's state are one run
    runs = edges("begins", "b0", "n").join(edges("ends", "e0", "last"), ["entity", "state", "run"])
    # the point after the run's last ends it; the run's first point has the start and the attributes
    stop = numbered.select("entity", (F.col("n") - 1).alias("last"), F.col("at").alias("end_us"))
    begun = numbered.select("entity", "n", "at")
    out = runs.join(stop, ["entity", "last"], "left").join(begun, ["entity", "n"]).join(points.select("entity", "at", "attrs"), ["entity", "at"])
    return out.select(F.col("entity").alias(entity), F.col("at").alias("start_us"), "end_us", "attrs.*", F.col("end_us").isNull().alias("is_current"))


def compare_history(expected: DataFrame, stored: DataFrame, entity: str, attributes: Sequence[str]) -> DataFrame:
    """entity, start_us of the versions that ``stored`` doesn't hold exactly once, right in attributes, end and flag.

    Both have entity, start_us, end_us, *attributes, is_current. Repeated stored rows count once; stored rows with a null
    entity or start are ignored.
    """
    state = [*attributes, "end_us", "is_current"]
    sides = expected.select(entity, "start_us", attribute_hash(state).alias("state"), F.lit(1).alias("want"), F.lit(0).alias("have"))
    sides = sides.unionByName(stored.where(F.col(entity).isNotNull() & F.col("start_us").isNotNull()).select(entity, "start_us", attribute_hash(state).alias("state"), F.lit(0).alias("want"), F.lit(1).alias("have")))
    states = sides.groupBy(entity, "start_us", "state").agg(F.max("want").alias("want"), F.max("have").alias("have"))
    return states.groupBy(entity, "start_us").agg(F.min(F.least("want", "have")).alias("right"), F.count(F.lit(1)).alias("n")).where((F.col("right") == 0) | (F.col("n") > 1)).select(entity, "start_us")
