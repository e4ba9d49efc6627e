"""SQL of the data-problem queries, for DuckDB."""

_NODES = r"""
sides AS (SELECT regexp_replace(parent_gold_object_id, '^\s+|\s+$', '', 'g') AS parent, regexp_replace(child_gold_object_id, '^\s+|\s+$', '', 'g') AS child FROM gold_dependency),
links AS (SELECT DISTINCT parent, child FROM sides WHERE parent IS NOT NULL AND child IS NOT NULL),
nodes AS (SELECT parent AS node FROM sides WHERE parent IS NOT NULL UNION SELECT child FROM sides WHERE child IS NOT NULL),
reach AS (SELECT parent AS a, child AS b FROM links UNION SELECT r.a, l.child FROM reach r JOIN links l ON l.parent = r.b),
looped AS (SELECT DISTINCT a AS node FROM reach WHERE a = b),
touched AS (SELECT node FROM looped UNION SELECT r.b FROM reach r JOIN looped ON looped.node = r.a),
ways AS (
  SELECT node, node AS root, 0 AS depth FROM nodes WHERE node NOT IN (SELECT child FROM links) AND node NOT IN (SELECT node FROM touched)
  UNION
  SELECT l.child, w.root, w.depth + 1 FROM ways w JOIN links l ON l.parent = w.node WHERE l.child NOT IN (SELECT node FROM touched)
)"""

_P2 = """
lines AS (SELECT sales_order_id, sales_order_detail_id, order_date, customer_key, product_key, territory_key FROM fact_sales_order),
long AS (
  SELECT sales_order_id, sales_order_detail_id, order_date, 'customer_key' AS ref_column, customer_key AS key FROM lines WHERE customer_key IS NOT NULL
  UNION ALL SELECT sales_order_id, sales_order_detail_id, order_date, 'product_key', product_key FROM lines WHERE product_key IS NOT NULL
  UNION ALL SELECT sales_order_id, sales_order_detail_id, order_date, 'territory_key', territory_key FROM lines WHERE territory_key IS NOT NULL),
dims AS (
  SELECT 'customer_key' AS ref_column, customer_key AS key, min(_effective_start_ts) AS valid_from, CAST(NULL AS TIMESTAMPTZ) AS deleted_at FROM dim_customer GROUP BY customer_key
  UNION ALL SELECT 'product_key', product_key, NULL, min(CASE WHEN _is_deleted THEN _deleted_at END) FROM dim_product GROUP BY product_key
  UNION ALL SELECT 'territory_key', territory_key, NULL, min(CASE WHEN _is_deleted THEN _deleted_at END) FROM dim_territory GROUP BY territory_key),
found AS (
  SELECT DISTINCT sales_order_id, sales_order_detail_id, order_date, l.ref_column,
    CASE WHEN d.key IS NULL THEN 'missing' WHEN order_date < valid_from THEN 'late' WHEN order_date >= deleted_at THEN 'deleted' END AS kind
  FROM long l LEFT JOIN dims d ON d.ref_column = l.ref_column AND d.key = l.key)"""

_P5 = """
picked AS (SELECT * FROM stage_dim_customer WHERE customer_key IS NOT NULL AND _effective_start_ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_key, _effective_start_ts ORDER BY _staged_at DESC NULLS LAST) = 1),
marked AS (SELECT *, row(store_id, territory_key, person_type, first_name, last_name, full_name) AS attrs,
  lag(row(store_id, territory_key, person_type, first_name, last_name, full_name)) OVER (PARTITION BY customer_key ORDER BY _effective_start_ts) AS prev,
  row_number() OVER (PARTITION BY customer_key ORDER BY _effective_start_ts) AS n FROM picked),
versions AS (SELECT customer_key, store_id, territory_key, person_type, first_name, last_name, full_name, _effective_start_ts,
  lead(_effective_start_ts) OVER (PARTITION BY customer_key ORDER BY _effective_start_ts) AS _effective_end_ts FROM marked WHERE n = 1 OR attrs IS DISTINCT FROM prev),
expected AS (SELECT *, _effective_end_ts IS NULL AS _is_current FROM versions),
stored AS (SELECT DISTINCT customer_key, store_id, territory_key, person_type, first_name, last_name, full_name, _effective_start_ts, _effective_end_ts, _is_current
  FROM dim_customer WHERE customer_key IS NOT NULL AND _effective_start_ts IS NOT NULL),
wrong AS ((SELECT * FROM stored EXCEPT SELECT * FROM expected) UNION ALL (SELECT * FROM expected EXCEPT SELECT * FROM stored))"""

_P7 = """
keyed AS (SELECT object_id, [lower(replace(x, '_', '')) FOR x IN regexp_extract_all(key_columns_json, '["'']([^"'']+)["'']', 1)] AS names FROM source_object),
live AS (SELECT b.*, k.names FROM bronze_product b JOIN keyed k USING (object_id) WHERE _is_deleted IS DISTINCT FROM true AND len(names) > 0),
named AS (SELECT *, array_to_string([coalesce(CASE x WHEN 'productid' THEN CAST(product_id AS VARCHAR) WHEN 'productnumber' THEN product_number WHEN 'sitecode' THEN site_code END, '') FOR x IN names], '|') AS record_key FROM live),
single AS (SELECT *, row(product_id, product_number, site_code, name, color, standard_cost, list_price, modified_date) AS content FROM named
  QUALIFY row_number() OVER (PARTITION BY object_id, _bronze_ingest_ts, record_key ORDER BY modified_date DESC NULLS LAST) = 1),
snaps AS (SELECT object_id, _bronze_ingest_ts AS ts, lag(_bronze_ingest_ts) OVER (PARTITION BY object_id ORDER BY _bronze_ingest_ts) AS before FROM (SELECT DISTINCT object_id, _bronze_ingest_ts FROM bronze_product)),
pairs AS (SELECT * FROM snaps WHERE before IS NOT NULL),
now AS (SELECT p.object_id, p.ts, s.record_key, s.content FROM pairs p JOIN single s ON s.object_id = p.object_id AND s._bronze_ingest_ts = p.ts),
old AS (SELECT p.object_id, p.ts, s.record_key, s.content FROM pairs p JOIN single s ON s.object_id = p.object_id AND s._bronze_ingest_ts = p.before)"""

_P3 = """
last AS (SELECT rule_id, run_id, evaluated_at, failed_count AS f, passed_count AS p FROM dq_result
  QUALIFY row_number() OVER (PARTITION BY rule_id, run_id ORDER BY evaluated_at DESC NULLS LAST, f DESC NULLS LAST, p DESC NULLS LAST) = 1),
usable AS (SELECT *, lag(f) OVER w AS pf, lag(p) OVER w AS pp FROM last WHERE f >= 0 AND p >= 0 AND f + p > 0 WINDOW w AS (PARTITION BY rule_id ORDER BY evaluated_at, run_id))"""

_P4 = """
times AS (SELECT object_id, ts, lag(ts) OVER (PARTITION BY object_id ORDER BY ts) AS before FROM (SELECT DISTINCT object_id, discovered_at AS ts FROM source_column)),
cols AS (SELECT object_id, discovered_at AS ts, column_name AS name, min(lower(trim(source_data_type))) AS kind FROM source_column WHERE is_active GROUP BY ALL),
newc AS (SELECT t.object_id, t.ts, t.before, c.name, c.kind FROM times t JOIN cols c ON c.object_id = t.object_id AND c.ts = t.ts WHERE t.before IS NOT NULL),
oldc AS (SELECT t.object_id, t.ts, t.before, c.name, c.kind FROM times t JOIN cols c ON c.object_id = t.object_id AND c.ts = t.before),
gone AS (SELECT * FROM oldc ANTI JOIN newc USING (object_id, ts, name)),
come AS (SELECT * FROM newc ANTI JOIN oldc USING (object_id, ts, name)),
file AS (SELECT object_id, landed_at, record_key, max(row_json) AS j FROM file_row GROUP BY ALL),
renamed AS (SELECT g.object_id, g.ts, g.name AS old, c.name AS new FROM gone g JOIN come c ON c.object_id = g.object_id AND c.ts = g.ts
  JOIN file a ON a.object_id = g.object_id AND a.landed_at = g.before JOIN file b ON b.object_id = g.object_id AND b.landed_at = g.ts AND b.record_key = a.record_key
  GROUP BY ALL HAVING bool_and(json_extract_string(a.j, '$."' || g.name || '"') IS NOT DISTINCT FROM json_extract_string(b.j, '$."' || c.name || '"')) AND count(json_extract_string(a.j, '$."' || g.name || '"')) > 0),
found AS (
  SELECT n.object_id, n.ts, 'TYPE_CHANGED' AS drift_type, n.name AS column_name, '' AS old_column_name FROM newc n JOIN oldc o ON o.object_id = n.object_id AND o.ts = n.ts AND o.name = n.name WHERE n.kind <> o.kind
  UNION ALL SELECT object_id, ts, 'COLUMN_RENAMED', new, old FROM renamed
  UNION ALL SELECT object_id, ts, 'COLUMN_REMOVED', name, '' FROM gone ANTI JOIN (SELECT object_id, ts, old AS name FROM renamed) r USING (object_id, ts, name)
  UNION ALL SELECT object_id, ts, 'COLUMN_ADDED', name, '' FROM come ANTI JOIN (SELECT object_id, ts, new AS name FROM renamed) r USING (object_id, ts, name)),
logged AS (SELECT object_id, column_name, CAST(detected_at AS DATE) AS day, count(*) AS n_logged FROM schema_drift_event GROUP BY ALL)"""

#: Columns that hold numbers, of the profiled tables, and the SQL of each table's loads.
_NUMBERS = {
    "dq_result": "failed_count passed_count", "dq_rule": "min_value max_value", "fact_sales_order": "sales_order_id sales_order_detail_id customer_key product_key territory_key order_qty unit_price line_total",
    "dim_customer": "customer_key customer_id store_id territory_key", "stage_dim_customer": "customer_key customer_id store_id territory_key", "bronze_product": "product_id standard_cost list_price", "file_row": "record_key",
    "raw_record": "record_id", "documents": "doc_id n_chars", "doc_label": "doc_id toxic", "gold_dependency": "", "source_object": "source_id", "source_column": "", "schema_drift_event": "",
}
_TIMES = {
    "dq_result": "evaluated_at", "fact_sales_order": "order_date _gold_updated_at", "dim_customer": "_effective_start_ts _effective_end_ts _gold_updated_at", "stage_dim_customer": "_effective_start_ts _staged_at",
    "bronze_product": "modified_date _bronze_ingest_ts", "file_row": "landed_at", "raw_record": "_bronze_ingest_ts", "documents": "written_at", "source_column": "discovered_at", "schema_drift_event": "detected_at",
}
_LOADS = {
    "dq_result": "run_id", "fact_sales_order": "_gold_run_id", "dim_customer": "_gold_run_id", "stage_dim_customer": "_run_id", "bronze_product": "_run_id", "file_row": "{landed_at}", "raw_record": "{_bronze_ingest_ts}",
    "documents": "substr(written_at, 1, 10)", "source_column": "{discovered_at}", "schema_drift_event": "run_id",
}


def _standard(name: str) -> str:
    text = lambda c: f"regexp_replace(regexp_replace(strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '[.]$', '')"
    times, numbers = _TIMES.get(name, "").split(), ", ".join(f"'{c}'" for c in _NUMBERS[name].split()) or "''"
    load = _LOADS.get(name, "''")
    load = load[1:-1] if load[0] == "{" else load
    replaced = f" REPLACE ({', '.join(f'{text(c)} AS {c}' for c in times)})" if times else ""
    return f"""SELECT '{name}' AS table_name, "column", load, count(*) AS n_rows, round(count(*) FILTER (value IS NULL) / count(*), 6) AS null_rate, count(DISTINCT value) AS n_distinct,
          min(value) FILTER ("column" NOT IN ({numbers})) AS min_value, max(value) FILTER ("column" NOT IN ({numbers})) AS max_value,
          min(CASE WHEN "column" IN ({numbers}) THEN TRY_CAST(value AS DOUBLE) END) AS min_number, max(CASE WHEN "column" IN ({numbers}) THEN TRY_CAST(value AS DOUBLE) END) AS max_number
        FROM (SELECT * FROM (SELECT {load} AS load, CAST(COLUMNS(t.*) AS VARCHAR) FROM (SELECT *{replaced} FROM {name}) t) UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(* EXCLUDE (load))))) GROUP BY ALL"""


SQL = {
    "p1_descendant_counts": r"""WITH RECURSIVE
        sides AS (SELECT regexp_replace(parent_gold_object_id, '^\s+|\s+$', '', 'g') AS parent, regexp_replace(child_gold_object_id, '^\s+|\s+$', '', 'g') AS child FROM gold_dependency),
        links AS (SELECT DISTINCT parent, child FROM sides WHERE parent IS NOT NULL AND child IS NOT NULL),
        nodes AS (SELECT parent AS node FROM sides WHERE parent IS NOT NULL UNION SELECT child FROM sides WHERE child IS NOT NULL),
        reach AS (SELECT parent AS a, child AS b FROM links UNION SELECT r.a, l.child FROM reach r JOIN links l ON l.parent = r.b)
        SELECT node AS gold_object_id, CAST(count(DISTINCT b) FILTER (b <> node) AS BIGINT) AS n_descendants FROM nodes LEFT JOIN reach ON a = node GROUP BY node""",
    "p3_standard": " UNION ALL ".join(_standard(name) for name in _NUMBERS),
    "p1_found": f"""WITH RECURSIVE {_NODES}
        SELECT node AS gold_object_id, root AS root_gold_object_id, CAST(max(depth) AS BIGINT) AS depth FROM ways GROUP BY node, root
        UNION ALL SELECT node, '', CAST(-1 AS BIGINT) FROM touched""",
    "p2_found": f"""WITH {_P2}
        SELECT DISTINCT sales_order_id, sales_order_detail_id, ref_column, kind FROM found WHERE kind IS NOT NULL""",
    "p3_found": f"""WITH {_P3}
        SELECT rule_id, '' AS run_id, 'null' AS issue FROM dq_rule WHERE rule_type IS NULL
        UNION ALL SELECT rule_id, '', 'pattern' FROM dq_rule WHERE rule_type NOT IN ('not_null', 'min', 'max', 'allowed_values', 'expression')
        UNION ALL SELECT rule_id, run_id, 'null' FROM last WHERE f IS NULL OR p IS NULL
        UNION ALL SELECT rule_id, run_id, 'range' FROM last WHERE f < 0 OR p < 0
        UNION ALL SELECT rule_id, run_id, 'shift' FROM usable WHERE abs(f / (f + p) - pf / (pf + pp)) > 0.2
        UNION ALL SELECT rule_id, run_id, 'volume' FROM usable WHERE (f + p) * 2 < pf + pp OR f + p > 2 * (pf + pp)""",
    "p4_found": f"WITH {_P4} SELECT object_id, CAST(epoch_us(ts) AS BIGINT) AS discovered_at_us, drift_type, column_name, old_column_name FROM found",
    "p4_log_check": f"""WITH {_P4} SELECT f.object_id, CAST(epoch_us(ts) AS BIGINT) AS discovered_at_us, drift_type, f.column_name, old_column_name, coalesce(n_logged, 0) AS n_logged
        FROM found f LEFT JOIN logged l ON l.object_id = f.object_id AND l.column_name = f.column_name AND l.day = CAST(f.ts AS DATE)""",
    "p5_found": f"""WITH {_P5}
        SELECT DISTINCT customer_key, CAST(epoch_us(_effective_start_ts) AS BIGINT) AS version_start_us FROM wrong""",
    "p5_history": f"""WITH {_P5} SELECT * REPLACE (_effective_start_ts AT TIME ZONE 'UTC' AS _effective_start_ts, _effective_end_ts AT TIME ZONE 'UTC' AS _effective_end_ts) FROM expected""",
    "p7_found": f"""WITH {_P7}
        SELECT object_id, CAST(epoch_us(ts) AS BIGINT) AS snapshot_us, record_key,
          CASE WHEN o.content IS NULL THEN 'added' WHEN n.content IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM now n FULL JOIN old o USING (object_id, ts, record_key) WHERE n.content IS DISTINCT FROM o.content""",
    "p2_report": f"""WITH {_P2}
        SELECT ref_column, kind, strftime(order_date, '%Y-%m') AS month, count(*) AS n_lines FROM found WHERE kind IS NOT NULL GROUP BY ALL""",
}
