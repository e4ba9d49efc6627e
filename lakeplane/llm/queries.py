"""Queries of the training-data problems, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane import scratch
from lakeplane.llm import duplicates, mixing, packing, tokens, toxicity
from lakeplane.plans.tables import table
from lakeplane.scratch import cut

# --- 6: duplicates hidden by formatting

#: Deliveries are taken into the ledger in this many batches, by time of ingestion.
LEDGER_BATCHES = 4


def _ledger(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    records = table(spark, folder, "raw_record")
    keyed = cut(duplicates.with_keys(records.withColumn("at", F.unix_micros("_bronze_ingest_ts")), "record_id", "row_json", extra=["at"]))
    edges = keyed.agg(F.percentile_approx("at", [k / LEDGER_BATCHES for k in range(1, LEDGER_BATCHES)], 1000)).first()[0] or []
    batch = F.coalesce(F.size(F.filter(F.array(*[F.lit(e) for e in edges]).cast("array<bigint>"), lambda e: e < F.col("at"))), F.lit(0))
    ledger = duplicates.Ledger(spark, scratch.fresh_path(spark, "ledger"))
    for k in range(len(edges) + 1):
        ledger.update(keyed.where(batch == k), f"batch {k}")
    return keyed, ledger.read()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.copies(*_ledger(spark, folder))


def p6_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct record once, as its earliest representative was landed, with its number of copies."""
    _, ledger = _ledger(spark, folder)
    rows = table(spark, folder, "raw_record").select(F.col("record_id").alias("first_record_id"), "row_json")
    return ledger.select("first_record_id", "n_copies").join(rows, "first_record_id")


# --- 8: containers


def _sizes(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return cut(tokens.with_token_counts(table(spark, folder, "documents").select("doc_id", *extra, "text"), "text"))


def _capacities(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    rows = table(spark, folder, "pack_capacity").where(F.col("capacity_tokens") > 0).orderBy("pack_id").collect()
    return [(r["pack_id"], r["capacity_tokens"]) for r in rows]


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_sizes(spark, folder), _capacities(spark, folder))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, folder), table(spark, folder, "pack_capacity"))


def p8_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """pack_id, n_docs, and what mustn't be: containers over capacity or with gaps in their places, texts split though they fit, pieces out of order."""
    capacities = table(spark, folder, "pack_capacity").where(F.col("capacity_tokens") > 0).select("pack_id", "capacity_tokens")
    packed = cut(p8_packed(spark, folder)).join(F.broadcast(capacities), "pack_id")  # configured, a few rows
    box = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("t"), F.max("capacity_tokens").alias("c"), F.count(F.lit(1)).alias("n"), F.countDistinct("place").alias("d"), F.min("place").alias("lo"), F.max("place").alias("hi"))
    doc = packed.groupBy("pack_id", "doc_id").agg(F.sum("n_tokens").alias("t"), F.max("capacity_tokens").alias("c"), F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("d"), F.max("piece").alias("hi"))
    count = lambda c, name: F.sum(c.cast("long")).alias(name)
    boxes = box.groupBy("pack_id").agg(count(F.col("t") > F.col("c"), "n_over"), count((F.col("d") != F.col("n")) | (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1), "n_gaps"))
    docs = doc.groupBy("pack_id").agg(F.count(F.lit(1)).alias("n_docs"), count((F.col("n") > 1) & (F.col("t") <= F.col("c")), "n_split"), count((F.col("d") != F.col("n")) | (F.col("hi") != F.col("n") - 1), "n_disordered"))
    return docs.join(boxes, "pack_id").select("pack_id", "n_docs", "n_over", "n_gaps", "n_split", "n_disordered")


# --- 9: mixing


def _mixed(spark: SparkSession, folder: str, met: float = 0.95) -> DataFrame:
    topic = F.split("pipeline_name", "_")
    sizes = _sizes(spark, folder, "source", "lang", "pipeline_name").withColumn("topic", F.get(topic, 1))
    return mixing.mix(sizes, table(spark, folder, "mix_target"), met)


def p9_mixed(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.share_report(_mixed(spark, folder), table(spark, folder, "mix_target"))


def p9_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """source, and what mustn't be: documents chosen twice, with more copies than allowed, or of another source."""
    mixed = _mixed(spark, folder)
    targets = table(spark, folder, "mix_target").select("source", "max_repeats")
    documents = table(spark, folder, "documents").select("doc_id", F.col("source").alias("own"))
    used = mixed.groupBy("doc_id", "source").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")).join(documents, "doc_id", "left").join(F.broadcast(targets), "source")  # configured
    count = lambda c, name: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(name)
    out = used.groupBy("source").agg(count(F.col("n") > 1, "n_twice"), count(F.col("copies") > F.col("max_repeats"), "n_over"), count(~F.col("own").eqNullSafe(F.col("source")), "n_foreign"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_twice", "n_over", "n_foreign")]
    return targets.select("source").join(out, "source", "left").select("source", *zero)


def p9_exact_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares where every source that is there reaches its target; the smallest one sets the total."""
    return mixing.share_report(_mixed(spark, folder, 1.0), table(spark, folder, "mix_target"))


# --- 10: abusive, hateful or sexual content


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return toxicity.score(documents, toxicity.model_for(spark, toxicity.labelled(documents, table(spark, folder, "doc_label"))))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_scores(spark, folder).where(F.col("score") >= toxicity.THRESHOLD).select("doc_id")


def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.rates(p10_scores(spark, folder))


QUERIES = {f.__name__: f for f in (p6_found, p6_records, p8_packed, p8_fill, p8_invariants, p9_mixed, p9_shares, p9_exact_shares, p9_invariants, p10_found, p10_scores, p10_rates)}

_P6 = r"""
fields AS (SELECT record_id, row_json, unnest(json_keys(row_json)) AS name FROM raw_record WHERE row_json IS NOT NULL),
pairs AS (SELECT record_id, lower(upper(regexp_replace(name, '[\p{P}\p{S}\p{Z}\p{C}\s]', '', 'g'))) AS name, json_extract_string(row_json, '$."' || name || '"') AS value FROM fields),
folded AS (SELECT record_id, name, CASE WHEN name = 'amount' THEN regexp_replace(value, '[^0-9A-Za-z.\-]', '', 'g') ELSE lower(upper(regexp_replace(value, '[\p{P}\p{S}\p{Z}\p{C}\s]', '', 'g'))) END AS value FROM pairs),
keyed AS (SELECT record_id, string_agg(name || '=' || value, '|' ORDER BY name, value) AS key FROM folded GROUP BY record_id),
grouped AS (SELECT record_id, key, min(record_id) OVER (PARTITION BY key) AS first_record_id, count(*) OVER (PARTITION BY key) AS n_copies FROM keyed)"""

SQL = {
    "p8_invariants": "SELECT pack_id, (SELECT count(*) FROM documents) AS n_docs, CAST(0 AS BIGINT) AS n_over, CAST(0 AS BIGINT) AS n_gaps, CAST(0 AS BIGINT) AS n_split, CAST(0 AS BIGINT) AS n_disordered FROM pack_capacity WHERE capacity_tokens > 0",
    "p9_invariants": "SELECT source, CAST(0 AS BIGINT) AS n_twice, CAST(0 AS BIGINT) AS n_over, CAST(0 AS BIGINT) AS n_foreign FROM mix_target",
    "p6_found": f"WITH {_P6} SELECT first_record_id, record_id FROM grouped WHERE record_id <> first_record_id",
    "p6_records": f"WITH {_P6} SELECT first_record_id, n_copies, row_json FROM grouped JOIN raw_record USING (record_id) WHERE record_id = first_record_id",
}
