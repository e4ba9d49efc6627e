"""Source queries of the gold models, as SQL over silver tables registered as views.

Roles in the test tables: order detail and header are lineitem and orders, customers and persons customer, territories
nation with region, products part, with its type as category and its brand as subcategory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Model name to (tables it reads, SQL).
MODELS: dict[str, tuple[Sequence[str], str]] = {
    "dim_category": (["part"], "SELECT p_type AS category_id, min(p_type) AS category_name FROM part WHERE p_type IS NOT NULL GROUP BY p_type"),
    "dim_subcategory": (["part", "dim_category"], "SELECT s.subcategory_id, s.subcategory_name, c.category_id, c.category_name FROM (SELECT p_brand AS subcategory_id, min(p_brand) AS subcategory_name, min(p_type) AS category_id FROM part GROUP BY p_brand) s LEFT JOIN dim_category c ON c.category_id = s.category_id"),
    "dim_product_model": (["part", "dim_subcategory"], "SELECT p.p_partkey AS product_key, p.p_name AS product_name, p.p_size AS product_size, s.subcategory_name, s.category_name FROM part p LEFT JOIN dim_subcategory s ON s.subcategory_id = p.p_brand"),
    "dim_territory_model": (["nation", "region"], "SELECT n.n_nationkey AS territory_key, n.n_name AS territory_name, r.r_name AS `group` FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"),
    "dim_customer_model": (["customer", "dim_territory_model"], "SELECT c.c_custkey AS customer_key, concat_ws(' ', c.c_mktsegment, c.c_name) AS full_name, t.territory_key, t.territory_name FROM customer c LEFT JOIN dim_territory_model t ON t.territory_key = c.c_nationkey"),
    "fact_sales": (["lineitem", "orders", "part", "customer"], "SELECT l.l_orderkey AS sales_order_id, l.l_linenumber AS sales_order_detail_id, o.o_orderdate AS order_date, c.c_custkey AS customer_key, p.p_partkey AS product_key, c.c_nationkey AS territory_key, l.l_quantity AS order_qty, l.l_extendedprice AS line_total FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey JOIN customer c ON c.c_custkey = o.o_custkey"),
    "sales_by_territory": (["fact_sales", "nation"], "SELECT f.territory_key, n.n_name AS territory_name, CAST(sum(CAST(f.line_total AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, CAST(sum(f.order_qty) AS DOUBLE) AS total_qty, count(1) AS n_lines FROM fact_sales f LEFT JOIN nation n ON n.n_nationkey = f.territory_key GROUP BY f.territory_key, n.n_name"),
    "fact_sales_by_territory": (["fact_sales_order", "dim_territory"], "SELECT f.territory_key, t.territory_name, CAST(sum(CAST(f.line_total AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, CAST(sum(f.order_qty) AS BIGINT) AS total_qty, count(1) AS n_lines FROM fact_sales_order f LEFT JOIN dim_territory t ON t.territory_key = f.territory_key GROUP BY f.territory_key, t.territory_name"),
    "sales_current_customer": (["fact_sales_order", "dim_customer"], "SELECT f.sales_order_id, f.sales_order_detail_id, f.customer_key, c.full_name FROM (SELECT DISTINCT sales_order_id, sales_order_detail_id, customer_key FROM fact_sales_order) f JOIN (SELECT customer_key, max(full_name) AS full_name FROM dim_customer WHERE _is_current GROUP BY customer_key) c ON c.customer_key = f.customer_key"),
    "dim_survey": ([], "SELECT * FROM VALUES (1, 'Products', 'yearly'), (2, 'Territories', 'monthly') AS t(survey_key, survey_name, rhythm)"),
    "dim_plan": (["dim_customer", "stage_dim_customer"], "SELECT DISTINCT person_type AS plan_id FROM (SELECT person_type FROM dim_customer WHERE person_type IS NOT NULL UNION SELECT person_type FROM stage_dim_customer WHERE person_type IS NOT NULL)"),
    "response_headers": (["dim_product", "dim_territory", "supplier", "customer"], "SELECT 1 AS survey_key, CAST(product_key AS STRING) AS respondent, category_name AS plan_id, CAST(NULL AS STRING) AS segment FROM dim_product UNION ALL SELECT 2, CAST(territory_key AS STRING), territory_group, country_region_code FROM dim_territory UNION ALL SELECT 3, CAST(s_suppkey AS STRING), CAST(NULL AS STRING), s_name FROM supplier UNION ALL SELECT 4, CAST(c_custkey AS STRING), CAST(NULL AS STRING), c_mktsegment FROM customer"),
}


def needed(name: str) -> list[str]:
    """Models that a model reads, each after those it reads itself, and the model last."""
    out: list[str] = []

    def visit(n: str) -> None:
        for below in MODELS[n][0]:
            if below in MODELS:
                visit(below)
        if n not in out:
            out.append(n)

    visit(name)
    return out


def build(spark: SparkSession, name: str, read: Callable[[str], DataFrame], resolve: Callable[[str], str] = "model_{}".format) -> DataFrame:
    """A model's rows, with the models below it as views: Catalyst plans them as one query."""
    for n in needed(name):
        tables, sql = MODELS[n]
        for t in tables:
            if t not in MODELS:
                read(t).createOrReplaceTempView(resolve(t))
        for t in tables:
            sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {resolve(t)}", sql)
        out = spark.sql(sql)
        out.createOrReplaceTempView(resolve(n))
    return out


def duckdb_sql(name: str) -> str:
    """The same models as common table expressions."""
    quote = lambda s: s.replace("`", '"').replace(" STRING)", " VARCHAR)")
    parts = [f"{n} AS ({quote(MODELS[n][1])})" for n in needed(name)]
    parts = [p.replace("SELECT * FROM VALUES (1, 'Products', 'yearly'), (2, 'Territories', 'monthly') AS t(", "SELECT * FROM (VALUES (1, 'Products', 'yearly'), (2, 'Territories', 'monthly')) AS t(") for p in parts]
    return f"WITH {', '.join(parts)} SELECT * FROM {name}"
