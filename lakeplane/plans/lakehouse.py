"""Queries of the lakehouse operators over the test tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane.audit import latest_watermarks
from lakeplane.config import Config
from lakeplane.functions.cleanse import apply_cleansing
from lakeplane.functions.hashing import row_hash, row_hash_v2, surrogate_key
from lakeplane.naming import landed_table
from lakeplane.operators import discovery, quality, shape
from lakeplane.operators import effective_history as history
from lakeplane.operators.dimensions import gold_merge, scd2
from lakeplane.operators.upsert import duplicate_keys, latest_per_key, mark_deleted, parity, upsert
from lakeplane.plans import models
from lakeplane.plans.dag import topo_levels
from lakeplane.plans.tables import table
from lakeplane.security import secure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def _model(name: str) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return models.build(spark, name, lambda t: table(spark, folder, t))

    QUERIES[name], SQL[name] = run, models.duckdb_sql(name)


for _name in models.MODELS:
    _model(_name)
SQL["fact_sales"] = SQL["fact_sales"].replace("SELECT * FROM fact_sales", "SELECT * REPLACE (CAST(epoch_us(order_date) AS BIGINT) AS order_date) FROM fact_sales")
_fact_sales = QUERIES["fact_sales"]
QUERIES["fact_sales"] = lambda spark, folder: _fact_sales(spark, folder).withColumn("order_date", F.unix_micros(F.col("order_date").cast("timestamp")))


# --- projections, filters, watermarks


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def select_list(spark: SparkSession, folder: str) -> DataFrame:
    return shape.apply_select(table(spark, folder, "orders"), ["o_orderkey", "o_orderstatus", "not_there"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(substr(o_orderpriority, 1, 1) AS VARCHAR) AS first, TRY_CAST(o_orderstatus AS INTEGER) AS status FROM orders")
def select_items(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").withColumn("p", F.left("o_orderpriority", F.lit(1)))
    return shape.apply_select(df, [{"source": "o_orderkey", "name": "order_id", "type": "string"}, {"source": "p", "name": "first"}, {"source": "o_orderstatus", "name": "status", "type": "int"}])


@query("SELECT o_custkey AS customer, CAST(o_orderkey AS INTEGER) AS id FROM orders")
def select_dict(spark: SparkSession, folder: str) -> DataFrame:
    return shape.apply_select(table(spark, folder, "orders"), {"columns": ["o_custkey", "o_orderkey"], "rename": {"o_custkey": "customer", "o_orderkey": "id"}, "cast": {"id": "int"}})


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE trim(o_orderstatus) = 'F'")
def filter_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return shape.ingest_filter(table(spark, folder, "orders"), {"o_orderstatus": "F", "unknown": 1}).select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def watermark_delta(spark: SparkSession, folder: str) -> DataFrame:
    return shape.newer_than(table(spark, folder, "orders"), "o_orderdate", "2000-01-01 00:00:00").select("o_orderkey")


@query("SELECT count(*) AS n_rows, strftime(max(o_orderdate), '%Y-%m-%d') AS watermark FROM orders")
def watermark_max(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("n_rows"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("watermark"))


@query("SELECT object_id, max_by(run_id, (evaluated_at, run_id)) AS watermark_value FROM dq_result WHERE evaluated_at IS NOT NULL GROUP BY object_id")
def watermark_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_watermarks(table(spark, folder, "dq_result").where(F.col("evaluated_at").isNotNull()).select("object_id", F.col("run_id").alias("watermark_value"), F.col("evaluated_at").alias("updated_at")))


@query("SELECT p_partkey, p_name, 'r1' AS _run_id, 'erp' AS _source_system, 'production.part' AS _source_table, CAST(1704067200000000 AS BIGINT) AS _bronze_ingest_us FROM part")
def bronze_stamp(spark: SparkSession, folder: str) -> DataFrame:
    out = shape.stamp_bronze(table(spark, folder, "part").select("p_partkey", "p_name"), "r1", "erp", "production.part", T1)
    return out.withColumn("_bronze_ingest_us", F.unix_micros("_bronze_ingest_ts")).drop("_bronze_ingest_ts")


@query("SELECT 'p' || json_extract_string(props, '$.k') AS page, count(*) AS n FROM events GROUP BY 1")
def json_field(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy(F.concat(F.lit("p"), F.get_json_object("props", "$.k")).alias("page")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang AS meta_lang, source AS meta_source, coalesce('[\"' || lang || '\"]', '[null]') AS tags FROM documents")
def json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "documents").select("doc_id", F.struct("lang", "source").alias("meta"), F.array("lang").alias("tags"))
    return shape.flatten(df)


# --- hashes, latest rows, upserts, deletes

_HASHED = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


@query("SELECT c_custkey, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)) AS _row_hash FROM customer")
def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", row_hash(_HASHED).alias("_row_hash"))


@query("SELECT customer_key, _effective_start_us, sha256(coalesce(length(first_name) || ':' || first_name, '-:') || coalesce(length(last_name) || ':' || last_name, '-:')) AS _row_hash FROM (SELECT *, CAST(epoch_us(_effective_start_ts) AS BIGINT) AS _effective_start_us FROM dim_customer)")
def row_hashes_v2(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "dim_customer").select("customer_key", F.unix_micros("_effective_start_ts").alias("_effective_start_us"), row_hash_v2(["first_name", "last_name"]).alias("_row_hash"))


@query("SELECT DISTINCT sha256(coalesce(text, '<NULL>') || '||' || coalesce(lang, '<NULL>')) AS _row_hash FROM documents")
def row_hash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(row_hash(["text", "lang"]).alias("_row_hash")).dropDuplicates(["_row_hash"])


@query("SELECT customer_key, max_by(full_name, (_staged_at, _effective_start_ts)) AS full_name FROM stage_dim_customer WHERE _staged_at IS NOT NULL AND _effective_start_ts IS NOT NULL GROUP BY customer_key")
def latest_customer(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "stage_dim_customer").where(F.col("_staged_at").isNotNull() & F.col("_effective_start_ts").isNotNull()).select("customer_key", "full_name", F.struct("_staged_at", "_effective_start_ts").alias("_at"))
    return latest_per_key(rows, ["customer_key"], "_at").select("customer_key", "full_name")


@query("SELECT DISTINCT object_id, product_id, name FROM bronze_product JOIN (SELECT object_id, max(_bronze_ingest_ts) AS _bronze_ingest_ts FROM bronze_product GROUP BY object_id) USING (object_id, _bronze_ingest_ts)")
def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "bronze_product")
    last = rows.groupBy("object_id").agg(F.max("_bronze_ingest_ts").alias("_bronze_ingest_ts"))
    return rows.join(last, ["object_id", "_bronze_ingest_ts"], "left_semi").select("object_id", "product_id", "name").distinct()


def _batch(spark: SparkSession, folder: str, keep: Column) -> DataFrame:
    return table(spark, folder, "customer").where(keep).select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, c_name, c_custkey % 10 = 3 AS _is_deleted, CASE WHEN c_custkey % 10 = 3 THEN CAST(1706745600000000 AS BIGINT) END AS _deleted_us FROM customer")
def soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    alive = _batch(spark, folder, F.col("c_custkey") % 10 != 3)
    out = mark_deleted(_batch(spark, folder, F.lit(True)), alive, ["c_custkey"], F.lit(T2))
    return out.select("c_custkey", "c_name", "_is_deleted", F.unix_micros("_deleted_at").alias("_deleted_us"))


_CHANGED = "CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment || ' 2' ELSE c_mktsegment END"


def _changed(df: DataFrame, step: int, mark: str) -> DataFrame:
    return df.withColumn("c_mktsegment", F.when(F.col("c_custkey") % step == 0, F.concat("c_mktsegment", F.lit(mark))).otherwise(F.col("c_mktsegment")))


@query(f"SELECT c_custkey, c_name, {_CHANGED} AS c_mktsegment FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 10 <> 3")
def upserted(spark: SparkSession, folder: str) -> DataFrame:
    target = _batch(spark, folder, F.col("c_custkey") % 10 != 3)
    source = _changed(_batch(spark, folder, F.col("c_custkey") % 4 == 0), 4, " 2")
    return upsert(target, source, ["c_custkey"])


@query("SELECT territory_key, sum(n) AS n FROM (SELECT CASE WHEN territory_key % 2 = 0 THEN NULL ELSE territory_key END AS territory_key, 1 AS n FROM (SELECT DISTINCT CASE WHEN territory_key % 2 = 0 THEN NULL ELSE territory_key END AS territory_key FROM dim_territory)) GROUP BY territory_key")
def upsert_null_key(spark: SparkSession, folder: str) -> DataFrame:
    """Loading the same keys twice, a null one among them, gives each key once."""
    rows = table(spark, folder, "dim_territory").select(F.when(F.col("territory_key") % 2 != 0, F.col("territory_key")).alias("territory_key")).distinct()
    return upsert(rows, rows, ["territory_key"]).groupBy("territory_key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE s_name END AS s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'r2' ELSE 'r1' END AS _gold_run_id FROM supplier")
def scd1(spark: SparkSession, folder: str) -> DataFrame:
    stage = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    first = gold_merge(None, stage, "scd1", ["s_suppkey"], "r1", T1)
    second = stage.where(F.col("s_suppkey") % 2 == 0).withColumn("s_name", F.upper("s_name"))
    return gold_merge(first, second, "scd1", ["s_suppkey"], "r2", T2).drop("_gold_updated_at")


@query("SELECT DISTINCT sales_order_id, sales_order_detail_id, 'r2' AS _gold_run_id FROM fact_sales_order")
def fact_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A fact loaded twice holds each key once."""
    stage = table(spark, folder, "fact_sales_order").select("sales_order_id", "sales_order_detail_id").distinct()
    keys = ["sales_order_id", "sales_order_detail_id"]
    return gold_merge(gold_merge(None, stage, "fact", keys, "r1", T1), stage, "fact", keys, "r2", T2).drop("_gold_updated_at")


@query("""WITH v AS (SELECT c_custkey, 1 AS n, c_mktsegment, true AS live FROM customer
    UNION ALL SELECT c_custkey, 2, c_mktsegment || ' 2', true FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT c_custkey, 3, c_mktsegment || ' 3', true FROM customer WHERE c_custkey % 8 = 0
    UNION ALL SELECT c_custkey, 3, c_mktsegment, true FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 8 <> 0),
  t AS (SELECT *, lead(n) OVER (PARTITION BY c_custkey ORDER BY n) AS nxt FROM v)
  SELECT c_custkey, c_mktsegment, CASE n WHEN 1 THEN '2024-01' WHEN 2 THEN '2024-02' ELSE '2024-03' END AS started, CASE nxt WHEN 2 THEN '2024-02' WHEN 3 THEN '2024-03' END AS ended, nxt IS NULL AS _is_current FROM t""")
def scd2_three_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads of customers; closed versions keep their end."""
    base, out = _batch(spark, folder, F.lit(True)).select("c_custkey", "c_mktsegment"), None
    for at, stage in ((T1, base), (T2, _changed(base, 4, " 2")), (T3, _changed(base, 8, " 3"))):
        out = scd2(out, stage, ["c_custkey"], F.lit(at))
    return out.select("c_custkey", "c_mktsegment", F.date_format("_effective_start_ts", "yyyy-MM").alias("started"), F.date_format("_effective_end_ts", "yyyy-MM").alias("ended"), "_is_current")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_report(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'orders' AS check_scope, 'row_count' AS check_name, CAST(count(*) AS VARCHAR) AS source_value, CAST(count(*) FILTER (o_orderkey % 100 <> 0) AS VARCHAR) AS target_value, 'FAIL' AS status FROM orders")
def parity_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return parity(rows, rows.where(F.col("o_orderkey") % 100 != 0), "orders").where(F.col("check_name") == "row_count")


# --- cleansing and masks


def _cleansed(spark: SparkSession, folder: str, name: str, columns: list[str], *rules: tuple[str, str, str]) -> DataFrame:
    df = table(spark, folder, name).select(*columns)
    return apply_cleansing(df, [{"rule_id": str(i), "function": f, "columns": c, "parameters_json": p, "apply_order": i} for i, (f, c, p) in enumerate(rules)])


@query("SELECT record_id, trim(file_name) AS file_name FROM raw_record")
def cleanse_trim(spark: SparkSession, folder: str) -> DataFrame:
    return _cleansed(spark, folder, "raw_record", ["record_id", "file_name"], ("trim", "file_name", "{}"))


@query("SELECT doc_id, nullif(lower(regexp_replace(trim(text, ' '), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), '') AS text FROM documents")
def cleanse_normalize(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "documents").select("doc_id", "text")
    return apply_cleansing(df, [{"function": "normalize_text", "columns": "text", "parameters_json": '{"case": "lower"}'}])


@query("SELECT product_key, coalesce(color, 'none') AS color, coalesce(subcategory_key, -1) AS subcategory_key FROM dim_product")
def cleanse_fill(spark: SparkSession, folder: str) -> DataFrame:
    return _cleansed(spark, folder, "dim_product", ["product_key", "color", "subcategory_key"], ("fill_nulls", "color", '{"default": "none"}'), ("fill_nulls", "subcategory_key", '{"value": "-1"}'))


@query("SELECT run_id, CAST(try_strptime(substr(run_id, 5, 8), '%Y%m%d') AS DATE)::VARCHAR AS day FROM dq_result")
def cleanse_parse(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "dq_result").select("run_id", F.substring("run_id", 5, 8).alias("raw"))
    out = apply_cleansing(df, [{"function": "parse_datetime", "columns": "raw", "parameters_json": '{"formats": ["yyyy-MM-dd", "yyyyMMdd"], "into": "day"}'}])
    return out.select("run_id", F.col("day").cast("string").alias("day"))


@query("SELECT s_suppkey, replace(upper(s_name), '#', '-') AS s_name FROM supplier")
def cleanse_case_replace(spark: SparkSession, folder: str) -> DataFrame:
    return _cleansed(spark, folder, "supplier", ["s_suppkey", "s_name"], ("to_lower", "s_name", "{}"), ("to_upper", "s_name", "{}"), ("replace", "s_name", '{"pattern": "#", "replacement": "-"}'))


@query()
def cleanse_title(spark: SparkSession, folder: str) -> DataFrame:
    return _cleansed(spark, folder, "part", ["p_partkey", "p_name"], ("to_title", "p_name", "{}"))


@query("SELECT customer_key, '***' AS first_name, sha256(last_name) AS last_name, '***' || right(full_name, 4) AS full_name FROM dim_customer")
def static_masks(spark: SparkSession, folder: str) -> DataFrame:
    return _cleansed(spark, folder, "dim_customer", ["customer_key", "first_name", "last_name", "full_name"], ("mask", "first_name", '{"style": "redact"}'), ("mask", "last_name", '{"style": "hash"}'), ("mask", "full_name", '{"style": "partial", "keep": 4}'))


# --- data quality

_RULES = [
    {"rule_id": "r1", "rule_type": "not_null", "column_name": "customer_key", "severity": "Error"},
    {"rule_id": "r2", "rule_type": "min", "column_name": "OrderQty", "min_value": 0, "severity": "error"},
    {"rule_id": "r3", "rule_type": "max", "column_name": "order_qty", "max_value": 30, "severity": "warn"},
    {"rule_id": "r4", "rule_type": "allowed_values", "column_name": "territory_key", "allowed_values_json": "[1, 2, 3, 4, 5, 6, 7, 8]", "severity": "warn"},
    {"rule_id": "r5", "rule_type": "expression", "column_name": None, "rule_expression": "order_qty * 2 > territory_key", "severity": "error"},
]
_FAILS = ["customer_key IS NULL", "order_qty < 0", "order_qty > 30", "territory_key NOT IN (1, 2, 3, 4, 5, 6, 7, 8)", "(order_qty * 2 > territory_key) IS NOT TRUE"]
_FAIL_CASES = [f"CASE WHEN {f} THEN 1 ELSE 0 END" for f in _FAILS]
_KEPT = "sales_order_id, sales_order_detail_id, customer_key, territory_key, order_qty"


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return quality.evaluate(table(spark, folder, "fact_sales_order").select(*_KEPT.split(", ")), _RULES)


@query(" UNION ALL ".join(f"SELECT 'r{i + 1}' AS rule_id, CAST(sum({c}) AS BIGINT) AS failed_count, CAST(count(*) - sum({c}) AS BIGINT) AS passed_count, CASE WHEN sum({c}) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM fact_sales_order" for i, c in enumerate(_FAIL_CASES)))
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(_checked(spark, folder), _RULES)


@query(f"SELECT {_KEPT} FROM fact_sales_order WHERE {' + '.join(_FAIL_CASES[i] for i in (0, 1, 4))} = 0")
def dq_good(spark: SparkSession, folder: str) -> DataFrame:
    return quality.split(_checked(spark, folder))[0]


@query(f"SELECT {_KEPT} FROM fact_sales_order WHERE {' + '.join(_FAIL_CASES[i] for i in (0, 1, 4))} > 0")
def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return quality.split(_checked(spark, folder))[1].drop("_failed_rules")


# --- surveys

_QUESTIONS = ["color", "subcategory_name", "category_name", "subcategory_key"]
_ANSWERS = " UNION ALL ".join(f"SELECT sha256('1|' || product_key) AS response_key, '{c}' AS question_code, CAST({c} AS VARCHAR) AS answer_text FROM dim_product WHERE {c} IS NOT NULL" for c in _QUESTIONS)
_LONG = f"SELECT sha256(response_key || '|' || question_code) AS answer_key, response_key, 1 AS survey_key, question_code, sha256('1|' || question_code) AS question_key, answer_text, CASE WHEN regexp_matches(answer_text, '^-?[0-9]+([.][0-9]+)?$') THEN CAST(answer_text AS DOUBLE) END AS answer_numeric, length(answer_text) > 25 AS is_freetext FROM ({_ANSWERS})"


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    return shape.unpivot_answers(table(spark, folder, "dim_product").select("product_key", *_QUESTIONS), 1, "product_key", ["product_key"])


@query(_LONG)
def survey_answers(spark: SparkSession, folder: str) -> DataFrame:
    return _answers(spark, folder)


@query(f"SELECT question_key, survey_key, question_code, CAST(NULL AS VARCHAR) AS question_text, CASE WHEN max(length(answer_text)) > 25 THEN 'free_text' WHEN min(CASE WHEN answer_numeric IS NOT NULL THEN 1 ELSE 0 END) = 1 THEN 'likert' ELSE 'choice' END AS question_type, count(DISTINCT answer_text) AS distinct_answers, false AS is_kpi FROM ({_LONG}) GROUP BY question_key, survey_key, question_code")
def question_codebook(spark: SparkSession, folder: str) -> DataFrame:
    return shape.codebook(_answers(spark, folder))


@query("SELECT sales_order_id, sales_order_detail_id, sha256(concat_ws('|', CAST(sales_order_id AS VARCHAR), CAST(sales_order_detail_id AS VARCHAR))) AS line_key FROM fact_sales_order")
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "fact_sales_order").select("sales_order_id", "sales_order_detail_id", surrogate_key(F.col("sales_order_id"), F.col("sales_order_detail_id")).alias("line_key"))


# --- discovery, drift, order of builds

_SNAPS = "SELECT DISTINCT object_id, discovered_at, dense_rank() OVER (PARTITION BY object_id ORDER BY discovered_at DESC) AS r FROM source_column"


def _columns_at(spark: SparkSession, folder: str, back: int) -> DataFrame:
    """Active columns of each object's last snapshot, or of the one before."""
    rows = table(spark, folder, "source_column")
    times = rows.groupBy("object_id").agg(F.sort_array(F.collect_set("discovered_at"), False).alias("times"))
    at = times.select("object_id", F.get("times", F.lit(back)).alias("discovered_at")).where(F.col("discovered_at").isNotNull())
    return rows.join(at, ["object_id", "discovered_at"], "left_semi").where("is_active").select("object_id", "column_name", "source_data_type", "is_active").dropDuplicates(["object_id", "column_name"])


@query(f"""WITH s AS ({_SNAPS}), now AS (SELECT DISTINCT object_id, column_name FROM source_column c JOIN s USING (object_id, discovered_at) WHERE r = 1 AND is_active),
    old AS (SELECT DISTINCT object_id, column_name FROM source_column c JOIN s USING (object_id, discovered_at) WHERE r = 2 AND is_active)
    SELECT object_id, column_name, 'COLUMN_ADDED' AS drift_type, 'info' AS severity FROM (SELECT * FROM now EXCEPT SELECT * FROM old) WHERE object_id IN (SELECT object_id FROM old)
    UNION ALL SELECT object_id, column_name, 'COLUMN_REMOVED', 'warning' FROM (SELECT * FROM old EXCEPT SELECT * FROM now)""")
def drift_events(spark: SparkSession, folder: str) -> DataFrame:
    out = discovery.snapshot_drift(_columns_at(spark, folder, 1), _columns_at(spark, folder, 0), "r1", T1)
    return out.select("object_id", "column_name", "drift_type", "severity")


@query("SELECT source_id, source_schema, source_table FROM (SELECT DISTINCT source_id, source_schema, source_table FROM source_object) o WHERE NOT EXISTS (SELECT 1 FROM source_object r WHERE r.processing_state = 'ACTIVE' AND r.is_active AND r.source_id = o.source_id AND r.source_schema IS NOT DISTINCT FROM o.source_schema AND r.source_table IS NOT DISTINCT FROM o.source_table)")
def new_objects(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_object")
    found = rows.select("source_id", "source_schema", "source_table").distinct()
    return discovery.new_candidates(found, rows.where("is_active and processing_state = 'ACTIVE'"))


@query("SELECT object_id AS t_n, 'file' AS t_s, list(column_name ORDER BY column_name)::VARCHAR AS key_columns FROM (SELECT DISTINCT object_id, column_name FROM source_column WHERE is_active) GROUP BY object_id")
def table_candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_column").where("is_active").select(F.col("object_id").alias("T_N"), F.lit("file").alias("T_S"), F.col("column_name").alias("C_N")).distinct()
    keys = rows.withColumn("ORD", F.col("C_N"))
    out = discovery.candidates(rows.select("T_S", "T_N"), keys)
    return out.withColumn("key_columns", F.concat(F.lit("["), F.array_join("key_columns", ", "), F.lit("]")))


@query()
def landed_names(spark: SparkSession, folder: str) -> DataFrame:
    """The configured objects under their landed names; configuration is read on the driver."""
    rows = [r.asDict() for r in table(spark, folder, "source_object").orderBy("object_id").collect()]
    return spark.createDataFrame([(r["object_id"], *landed_table(r | {"source_name": f"Source {r['source_id']}"})) for r in rows], "object_id string, landed_schema string, landed_table string")


@query()
def build_order(spark: SparkSession, folder: str) -> DataFrame:
    """Levels of the gold models."""
    edges = [(t, n) for n, (tables, _) in models.MODELS.items() for t in tables if t in models.MODELS]
    return spark.createDataFrame([(i, n) for i, level in enumerate(topo_levels(models.MODELS, edges)) for n in level], "level int, model string")


@query("SELECT o.object_id, o.source_id, s.source_name FROM source_object o JOIN (SELECT DISTINCT source_id, 'source ' || source_id AS source_name FROM source_object WHERE source_id % 2 = 1) s USING (source_id) WHERE o.is_active AND coalesce(o.processing_state, 'ACTIVE') = 'ACTIVE'")
def work_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = [r.asDict() for r in table(spark, folder, "source_object").collect()]
    sources = [{"source_id": i, "source_name": f"source {i}", "load_group": i % 2} for i in sorted({r["source_id"] for r in rows})]
    config = Config({"datasource": sources, "source_object": rows})
    return spark.createDataFrame([(o["object_id"], o["source_id"], o["source_name"]) for o in config.objects(1)], "object_id string, source_id int, source_name string")


# --- history


def _orders(spark: SparkSession, folder: str, step: int | None = None) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return rows.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % step == 0, "X").otherwise(F.col("o_orderstatus"))) if step else rows


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    first = history.seed(_orders(spark, folder).where(F.col("o_orderkey") % 7 != 0), T1)
    return history.observe(first, _orders(spark, folder, 5), ["o_orderkey"], T2, T1)


_OBSERVED = """SELECT o_orderkey, o_orderstatus, '2024-01' AS valid_from, CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus <> 'X' THEN '2024-02' END AS valid_to, 'seed' AS origin FROM orders WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END, '2024-02', NULL, 'observed' FROM orders WHERE o_orderkey % 7 = 0 OR (o_orderkey % 5 = 0 AND o_orderstatus <> 'X')"""


@query(_OBSERVED)
def history_observed(spark: SparkSession, folder: str) -> DataFrame:
    out = _observed(spark, folder)
    return out.select("o_orderkey", "o_orderstatus", F.date_format(history.FROM, "yyyy-MM").alias("valid_from"), F.date_format(history.TO, "yyyy-MM").alias("valid_to"), F.col(history.ORIGIN).alias("origin"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def history_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return history.as_of(_observed(spark, folder), datetime(2024, 1, 15)).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, 'history' AS side FROM orders WHERE false")
def history_reconciled(spark: SparkSession, folder: str) -> DataFrame:
    return history.reconcile(_observed(spark, folder), _orders(spark, folder, 5), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'insert' WHEN o_orderkey % 11 = 0 THEN 'delete' ELSE 'update' END AS change FROM orders WHERE (o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0) OR (o_orderkey % 7 <> 0 AND (o_orderkey % 11 = 0 OR (o_orderkey % 5 = 0 AND o_orderstatus <> 'X')))")
def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    before = _orders(spark, folder).where(F.col("o_orderkey") % 7 != 0)
    after = _orders(spark, folder, 5).where(F.col("o_orderkey") % 11 != 0)
    return history.changes_between(before, after, ["o_orderkey"]).select("o_orderkey", F.col("_change").alias("change"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0")
def replayed(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot and the changes since give the table as it is."""
    before, after = _orders(spark, folder).where(F.col("o_orderkey") % 7 != 0), _orders(spark, folder, 5).where(F.col("o_orderkey") % 11 != 0)
    changes = history.changes_between(before, after, ["o_orderkey"]).withColumn("_at", F.lit(1))
    return history.replay(before, changes, ["o_orderkey"], "_at")


# --- security

_POLICIES = [
    {"policy_id": "1", "method": "CLS", "role_name": "analyst", "columns": "customer_key;full_name;first_name;territory_key"},
    {"policy_id": "2", "method": "RLS", "role_name": "analyst", "predicate": "SELECT * FROM dim_customer WHERE territory_key < 5"},
    {"policy_id": "3", "method": "DDM", "role_name": "analyst", "columns": "full_name", "mask_function": "email()"},
    {"policy_id": "4", "method": "DDM", "role_name": None, "columns": "first_name", "mask_function": 'partial(1,"--",1)'},
    {"policy_id": "5", "method": "DDM", "role_name": None, "columns": "store_id", "mask_function": "default()"},
]


@query("SELECT customer_key, left(full_name, 1) || 'XXX@XXXX.com' AS full_name, CASE WHEN length(first_name) > 2 THEN left(first_name, 1) || '--' || right(first_name, 1) WHEN first_name IS NOT NULL THEN '--' END AS first_name, territory_key FROM dim_customer WHERE territory_key < 5")
def secured_analyst(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "dim_customer").select("customer_key", "store_id", "full_name", "first_name", "territory_key")
    return secure(df, _POLICIES, "analyst")


@query("SELECT customer_key, CASE WHEN store_id IS NOT NULL THEN 0 END AS store_id, full_name, CASE WHEN length(first_name) > 2 THEN left(first_name, 1) || '--' || right(first_name, 1) WHEN first_name IS NOT NULL THEN '--' END AS first_name FROM dim_customer")
def secured_other(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "dim_customer").select("customer_key", "store_id", "full_name", "first_name")
    return secure(df, _POLICIES[2:], "clerk")
