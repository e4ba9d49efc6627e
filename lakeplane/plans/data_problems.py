"""Queries of the general data problems: hierarchies, references, profiles, drift, history and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane.operators import bitmap_history, profile, schema_drift, snapshot_diff
from lakeplane.operators import hierarchy as tree
from lakeplane.operators import references as refs
from lakeplane.plans.tables import table
from lakeplane.scratch import cut

# --- 1: hierarchies


def _dependency(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tree.clean_links(table(spark, folder, "gold_dependency"), "parent_gold_object_id", "child_gold_object_id")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    out = tree.hierarchy(*_dependency(spark, folder))
    return out.select(F.col("node").alias("gold_object_id"), F.col("root").alias("root_gold_object_id"), "depth")


def p1_paths(spark: SparkSession, folder: str) -> DataFrame:
    out = tree.hierarchy(*_dependency(spark, folder), with_path=True, place_cycles=True)
    return out.select(F.col("node").alias("gold_object_id"), F.col("root").alias("root_gold_object_id"), "depth", F.array_join("path", " > ").alias("path"), F.col("head").alias("tree"), "lft", "rgt")


def p1_descendants(spark: SparkSession, folder: str) -> DataFrame:
    out = tree.descendants(*_dependency(spark, folder))
    return out.select(F.col("node").alias("gold_object_id"), F.col("head").alias("tree"), "lft", "rgt")


def p1_descendant_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A node's ranges don't overlap, so their lengths add up to its descendants and itself."""
    out = p1_descendants(spark, folder).groupBy("gold_object_id").agg((F.sum(F.col("rgt") - F.col("lft") + 1) - 1).alias("n_descendants"))
    return out


# --- 2: references

REFERENCES = [
    refs.Reference("customer_key", "dim_customer", valid_from="_effective_start_ts"),
    refs.Reference("product_key", "dim_product", deleted="_is_deleted", deleted_at="_deleted_at"),
    refs.Reference("territory_key", "dim_territory", deleted="_is_deleted", deleted_at="_deleted_at"),
]


def _bad_references(spark: SparkSession, folder: str) -> DataFrame:
    dimensions = {r.dimension: table(spark, folder, r.dimension) for r in REFERENCES}
    return refs.check_references(table(spark, folder, "fact_sales_order"), ["sales_order_id", "sales_order_detail_id"], "order_date", REFERENCES, dimensions)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _bad_references(spark, folder).select("sales_order_id", "sales_order_detail_id", "ref_column", "kind").distinct()


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    return refs.report(_bad_references(spark, folder))


# --- 3: column profiles

#: The names of rule types, by which the expression's verdicts are checked exactly.
RULE_TYPES = ["not_null", "min", "max", "allowed_values", "expression"]
#: Tables that are profiled, all that grow, with the expression that tells their loads apart. Documents have no load of their
#: own, only a time of writing each, and count by day.
PROFILED = {
    "dq_result": "run_id", "dq_rule": None, "fact_sales_order": "_gold_run_id", "dim_customer": "_gold_run_id", "stage_dim_customer": "_run_id", "bronze_product": "_run_id", "file_row": "landed_at", "raw_record": "_bronze_ingest_ts",
    "documents": "to_date(written_at)", "doc_label": None, "gold_dependency": None, "source_object": None, "source_column": "discovered_at", "schema_drift_event": "run_id",
}


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    rules = profile.nonconforming_rows(table(spark, folder, "dq_rule"), "rule_type", ["rule_id"], RULE_TYPES).withColumn("run_id", F.lit(""))
    results = profile.measure_issues(table(spark, folder, "dq_result"), "rule_id", "run_id", "evaluated_at", "failed_count", "passed_count")
    return rules.select("rule_id", "run_id", "issue").unionByName(results.select("rule_id", "run_id", "issue"))


def _profiled(spark: SparkSession, folder: str) -> dict:
    tables = {name: table(spark, folder, name) for name in PROFILED}
    return {name: (df, F.expr(PROFILED[name]) if PROFILED[name] else F.lit(""), df.columns) for name, df in tables.items()}


def p3_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile_tables(_profiled(spark, folder)).withColumnRenamed("table", "table_name")


def p3_standard(spark: SparkSession, folder: str) -> DataFrame:
    """The part of the profile that needs no expressions."""
    return profile.standard_tables(_profiled(spark, folder)).withColumnRenamed("table", "table_name")


def p3_expressions(spark: SparkSession, folder: str) -> DataFrame:
    return profile.expressions(_profiled(spark, folder)).withColumnRenamed("table", "table_name")


# --- 4: schemas that drift


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.changes(table(spark, folder, "source_column"), table(spark, folder, "file_row"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _drift(spark, folder).select("object_id", F.col("at").alias("discovered_at_us"), "drift_type", "column_name", "old_column_name")


def p4_log_check(spark: SparkSession, folder: str) -> DataFrame:
    """Each change with the number of entries for it in the loads' own log; a rename is logged as an add or a removal."""
    log = table(spark, folder, "schema_drift_event").select("object_id", "column_name", F.to_date("detected_at").alias("day")).groupBy("object_id", "column_name", "day").agg(F.count(F.lit(1)).alias("n_logged"))
    found = _drift(spark, folder).withColumn("day", F.to_date(F.timestamp_micros("at")))
    return found.join(log, ["object_id", "column_name", "day"], "left").select("object_id", F.col("at").alias("discovered_at_us"), "drift_type", "column_name", "old_column_name", F.coalesce("n_logged", F.lit(0)).alias("n_logged"))


def _lives(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.lineages(table(spark, folder, "source_column"), cut(_drift(spark, folder)))


def p4_columns(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.target_columns(table(spark, folder, "source_column"), _lives(spark, folder))


def p4_unified(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.unify(table(spark, folder, "source_column"), table(spark, folder, "file_row"), _lives(spark, folder))


# --- 5: history of changing attributes

CUSTOMER_ATTRIBUTES = ["store_id", "territory_key", "person_type", "first_name", "last_name", "full_name"]


def _customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    return bitmap_history.versions(table(spark, folder, "stage_dim_customer"), "customer_key", "_effective_start_ts", "_staged_at", CUSTOMER_ATTRIBUTES)


def p5_history(spark: SparkSession, folder: str) -> DataFrame:
    out = _customer_versions(spark, folder)
    return out.select("customer_key", *CUSTOMER_ATTRIBUTES, F.timestamp_micros("start_us").alias("_effective_start_ts"), F.timestamp_micros("end_us").alias("_effective_end_ts"), F.col("is_current").alias("_is_current"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    stored = table(spark, folder, "dim_customer").select("customer_key", F.unix_micros("_effective_start_ts").alias("start_us"), F.unix_micros("_effective_end_ts").alias("end_us"), *CUSTOMER_ATTRIBUTES, F.col("_is_current").alias("is_current"))
    out = bitmap_history.compare_history(_customer_versions(spark, folder), stored, "customer_key", CUSTOMER_ATTRIBUTES)
    return out.select("customer_key", F.col("start_us").alias("version_start_us"))


# --- 7: changes between full snapshots

PRODUCT_COLUMNS = ["product_id", "product_number", "site_code", "name", "color", "standard_cost", "list_price", "modified_date"]


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    keys = snapshot_diff.key_columns(table(spark, folder, "source_object"), "object_id", "key_columns_json")
    rows = snapshot_diff.snapshot_rows(table(spark, folder, "bronze_product"), keys, "object_id", "_bronze_ingest_ts", "_is_deleted", "modified_date", PRODUCT_COLUMNS)
    out = snapshot_diff.diff_snapshots(rows)
    return out.select(F.col("source").alias("object_id"), F.col("at").alias("snapshot_us"), "record_key", "change")


QUERIES = {f.__name__: f for f in (p1_found, p1_paths, p1_descendants, p1_descendant_counts, p2_found, p2_report, p3_found, p3_profile, p3_standard, p3_expressions, p4_found, p4_log_check, p4_columns, p4_unified, p5_found, p5_history, p7_found)}
