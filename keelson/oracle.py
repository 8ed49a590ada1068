"""DuckDB SQL oracles for the registered queries.

The driver's tables are views (customer, part, orders, lineitem, events).
Shared building blocks are CTEs; each oracle pulls in the CTEs it needs,
in dependency order. Column names match ``keelson.registry``.
"""

from __future__ import annotations

from keelson.registry import PRICE_LOW_BELOW, PRICE_MEDIUM_BELOW, TOP_K

ITERATIONS, RESET = 10, 0.15

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (deps, body)


cte("vehicle_events", """
SELECT event_id AS id,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE concat('VIN', CAST(user_id AS VARCHAR)) END AS vin,
       CASE WHEN event_id % 25 = 0 THEN NULL
            WHEN event_id % 2 = 0 THEN concat(' ', event_type, ' ') ELSE event_type END AS manufacturer,
       CASE WHEN event_id % 20 = 1 THEN NULL ELSE concat('M', CAST(user_id % 5 AS VARCHAR)) END AS model,
       CAST(2015 + user_id % 8 AS INTEGER) AS year,
       CASE event_id % 7 WHEN 0 THEN 'D' WHEN 1 THEN 'R' WHEN 2 THEN 'N' WHEN 3 THEN 'P'
                         WHEN 4 THEN '3' WHEN 5 THEN 'X' ELSE NULL END AS gearPosition,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp
FROM events""")

_GEAR = ("CASE WHEN gearPosition = 'D' THEN '4' WHEN gearPosition = 'R' THEN '-1' "
         "WHEN gearPosition = 'N' THEN '0' WHEN gearPosition = 'P' THEN '0' ELSE gearPosition END")
_WALL = "epoch_ms((timestamp // 1000) * 1000)"
_DATE = f"strftime({_WALL}, '%Y-%m-%d')"
_HOUR = f"CAST(hour({_WALL}) AS INTEGER)"

cte("vehicle_clean", f"""
SELECT id, vin, trim(manufacturer) AS manufacturer, model, year, {_GEAR} AS gearPosition, timestamp,
       {_DATE} AS date, {_HOUR} AS hour
FROM vehicle_events WHERE vin IS NOT NULL""", "vehicle_events")

cte("customers", """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS location FROM customer
WHERE c_custkey % 15 < 12""")
cte("new_customers", """
SELECT c_custkey AS customer_id, concat(c_name, ' v2') AS name, c_mktsegment AS location FROM customer
WHERE c_custkey % 15 >= 10""")
cte("products", """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part
WHERE p_partkey % 15 < 12""")
cte("new_products", """
SELECT p_partkey AS product_id, concat(p_name, ' v2') AS name, p_type AS category, p_retailprice AS price
FROM part WHERE p_partkey % 15 >= 10""")
cte("all_customers", "SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS location FROM customer")
cte("all_products", "SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part")
_PURCHASE = """
SELECT l_orderkey * 10 + l_linenumber AS purchase_id, o_custkey AS customer_id, l_partkey AS product_id,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date,
       CAST(trunc(l_quantity) AS INTEGER) AS quantity, l_extendedprice AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE """
cte("purchases", _PURCHASE + "o_orderdate < TIMESTAMP '2001-01-01 00:00:00'")
cte("all_purchases", _PURCHASE + "true")
cte("new_purchases", _PURCHASE + "o_orderdate >= TIMESTAMP '2000-10-01 00:00:00'")


def _vertices(c: str, p: str) -> str:
    return f"""
SELECT 'c:' || CAST(customer_id AS VARCHAR) AS id, name, location, 'customer' AS vertex_type,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS DOUBLE) AS price FROM {c}
UNION ALL
SELECT 'p:' || CAST(product_id AS VARCHAR) AS id, name, CAST(NULL AS VARCHAR) AS location, 'product' AS vertex_type,
       category, price FROM {p}"""


def _edges(src: str) -> str:
    return f"""
SELECT purchase_id, 'c:' || CAST(customer_id AS VARCHAR) AS src, 'p:' || CAST(product_id AS VARCHAR) AS dst,
       purchase_date, quantity, amount, 'PURCHASED' AS relationship FROM {src}"""


cte("vertices", _vertices("customers", "products"), "customers", "products")
cte("all_vertices", _vertices("all_customers", "all_products"), "all_customers", "all_products")
cte("all_edges", _edges("all_purchases"), "all_purchases")
cte("new_vertices", _vertices("new_customers", "new_products"), "new_customers", "new_products")
cte("edges", _edges("purchases"), "purchases")
cte("new_edges", _edges("new_purchases"), "new_purchases")
cte("fresh_vertices", "SELECT * FROM new_vertices n WHERE NOT EXISTS (SELECT 1 FROM vertices v WHERE v.id = n.id)",
    "vertices", "new_vertices")
cte("fresh_edges", """SELECT * FROM new_edges n WHERE NOT EXISTS (
  SELECT 1 FROM edges e WHERE e.src = n.src AND e.dst = n.dst AND e.relationship = n.relationship)""",
    "edges", "new_edges")
cte("merged_vertices", "SELECT * FROM vertices UNION ALL SELECT * FROM fresh_vertices", "vertices", "fresh_vertices")
cte("merged_edges", "SELECT * FROM edges UNION ALL SELECT * FROM fresh_edges", "edges", "fresh_edges")
cte("graph_ids", "SELECT DISTINCT id FROM merged_vertices", "merged_vertices")
cte("graph_links", """
SELECT src, dst FROM merged_edges
WHERE src IN (SELECT id FROM graph_ids) AND dst IN (SELECT id FROM graph_ids)""", "merged_edges", "graph_ids")


def _pagerank_ctes(prefix: str, links: str) -> str:
    """Unrolled fixed-iteration PageRank; final CTE ``{prefix}`` (id, pagerank)."""
    cte(f"{prefix}_pairs", f"SELECT src, dst, count(*) AS m FROM {links} GROUP BY src, dst", links)
    cte(f"{prefix}_deg", f"SELECT src, sum(m) AS deg FROM {prefix}_pairs GROUP BY src", f"{prefix}_pairs")
    cte(f"{prefix}_w", f"""SELECT p.src, p.dst, CAST(p.m AS DOUBLE) / d.deg AS w
FROM {prefix}_pairs p JOIN {prefix}_deg d ON p.src = d.src""", f"{prefix}_pairs", f"{prefix}_deg")
    cte(f"{prefix}_r0", "SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM graph_ids", "graph_ids")
    for i in range(1, ITERATIONS + 1):
        prev = f"{prefix}_r{i - 1}"
        cte(f"{prefix}_r{i}", f"""
SELECT g.id, {RESET} + {1 - RESET} * coalesce(c.s, 0.0) AS rank
FROM graph_ids g LEFT JOIN (
  SELECT w.dst AS id, sum(w.w * r.rank) AS s FROM {prefix}_w w JOIN {prev} r ON w.src = r.id GROUP BY w.dst
) c ON g.id = c.id""", "graph_ids", f"{prefix}_w", prev)
    last = f"{prefix}_r{ITERATIONS}"
    cte(prefix, f"""
SELECT id, rank * (CAST((SELECT count(*) FROM {last}) AS DOUBLE) / (SELECT sum(rank) FROM {last})) AS pagerank
FROM {last}""", last)
    return prefix


cte("links_both", "SELECT src, dst FROM graph_links UNION ALL SELECT dst AS src, src AS dst FROM graph_links",
    "graph_links")
_pagerank_ctes("pr", "graph_links")
_pagerank_ctes("pr_both", "links_both")
cte("ranked", """SELECT v.id, v.vertex_type, round(p.pagerank, 6) AS pagerank, round(p.pagerank, 12) AS exact
FROM merged_vertices v JOIN pr p ON v.id = p.id""", "merged_vertices", "pr")
cte("ranked_both", """SELECT v.id, v.vertex_type, round(p.pagerank, 6) AS pagerank, round(p.pagerank, 12) AS exact
FROM merged_vertices v JOIN pr_both p ON v.id = p.id""", "merged_vertices", "pr_both")

cte("cc_links", "SELECT src AS a, dst AS b FROM graph_links UNION SELECT dst, src FROM graph_links", "graph_links")
cte("cc", """
  SELECT id, id AS comp FROM graph_ids
  UNION
  SELECT l.b AS id, min(cc.comp) AS comp
  FROM cc JOIN cc_links l ON l.a = cc.id
  JOIN recurring.cc AS cur ON cur.id = l.b
  GROUP BY l.b, cur.comp
  HAVING min(cc.comp) < cur.comp""", "graph_ids", "cc_links")
RECURSIVE = {"cc": "cc(id, comp) USING KEY (id)"}
cte("components", """SELECT v.id, v.vertex_type, c.comp AS component
FROM merged_vertices v JOIN cc c ON v.id = c.id""", "merged_vertices", "cc")


def _resolve(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def sql(select: str, *uses: str) -> str:
    names = _resolve(uses)
    if not names:
        return select.strip()
    parts = []
    for n in names:
        head = RECURSIVE.get(n, n)
        parts.append(f"{head} AS ({CTES[n][1]}\n)")
    kw = "WITH RECURSIVE" if any(n in RECURSIVE for n in names) else "WITH"
    return f"{kw} " + ",\n".join(parts) + "\n" + select.strip()


_BAND = (f"CASE WHEN p_retailprice < {PRICE_LOW_BELOW} THEN 'Low' "
         f"WHEN p_retailprice < {PRICE_MEDIUM_BELOW} THEN 'Medium' ELSE 'High' END")
_NOT_NUMERIC = "coalesce(NOT regexp_matches(gearPosition, '^-?[0-9]+$'), false)"
_UNTRIMMED = "coalesce(trim(manufacturer) <> manufacturer, false)"
_NULL_PCT = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(coalesce(100.0 * count(*) FILTER (WHERE {c} IS NULL) "
    f"/ nullif(count(*), 0), 0.0), 6) AS null_pct FROM vehicle_events"
    for c in ("vin", "manufacturer", "model", "year"))
_VEHICLE_METRICS = (
    " UNION ALL ".join(
        f"SELECT 'null_pct' AS metric, '{c}' AS group_key, "
        f"round(coalesce(100.0 * count(*) FILTER (WHERE {c} IS NULL) / nullif(count(*), 0), 0.0), 6) AS value, "
        f"CAST(NULL AS VARCHAR) AS text_value FROM vehicle_clean"
        for c in ("vin", "manufacturer", "model", "year"))
    + " UNION ALL SELECT 'count', manufacturer, CAST(count(*) AS DOUBLE), NULL FROM vehicle_clean GROUP BY manufacturer"
    + " UNION ALL SELECT 'gear_pos', gearPosition, CAST(count(*) AS DOUBLE), NULL FROM vehicle_clean GROUP BY gearPosition"
    + " UNION ALL SELECT 'min_date', NULL, NULL, min(date) FROM vehicle_clean"
    + " UNION ALL SELECT 'max_date', NULL, NULL, max(date) FROM vehicle_clean")
_GRAPH_METRICS = """
SELECT 'total_vertices' AS metric, CAST(NULL AS VARCHAR) AS group_key, CAST(count(*) AS DOUBLE) AS value,
       CAST(NULL AS VARCHAR) AS text_value FROM merged_vertices
UNION ALL SELECT 'total_edges', NULL, CAST(count(*) AS DOUBLE), NULL FROM merged_edges
UNION ALL SELECT 'customers_in', location, CAST(count(*) AS DOUBLE), NULL FROM merged_vertices
          WHERE vertex_type = 'customer' GROUP BY location
UNION ALL SELECT 'products_in', category, CAST(count(*) AS DOUBLE), NULL FROM merged_vertices
          WHERE vertex_type = 'product' GROUP BY category
UNION ALL SELECT 'min_date', NULL, NULL, min(purchase_date) FROM merged_edges WHERE relationship = 'PURCHASED'
UNION ALL SELECT 'max_date', NULL, NULL, max(purchase_date) FROM merged_edges WHERE relationship = 'PURCHASED'"""
_VEHICLE_COLS = "id, vin, manufacturer, model, year, gearPosition, timestamp, date, hour"
_COMBINED = """
SELECT id, name, location, vertex_type, category, price, 'vertex' AS dataset_type,
       CAST(NULL AS BIGINT) AS purchase_id, CAST(NULL AS VARCHAR) AS src, CAST(NULL AS VARCHAR) AS dst,
       CAST(NULL AS VARCHAR) AS purchase_date, CAST(NULL AS INTEGER) AS quantity, CAST(NULL AS DOUBLE) AS amount,
       CAST(NULL AS VARCHAR) AS relationship{extra_null} FROM {vertices}
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, 'edge', purchase_id, src, dst, purchase_date, quantity, amount,
       relationship{extra_edge} FROM merged_edges"""


def _top(vertex_type: str, ranked: str = "ranked") -> str:
    return (f"SELECT id, vertex_type, pagerank FROM {ranked} WHERE vertex_type = '{vertex_type}' "
            f"ORDER BY exact DESC, id ASC LIMIT {TOP_K}")


_RANKED = "SELECT id, vertex_type, pagerank FROM "


ORACLES: dict[str, str] = {
    "vehicle_etl": sql(f"SELECT {_VEHICLE_COLS} FROM vehicle_clean", "vehicle_clean"),
    "vehicle_trim": sql("SELECT id, trim(manufacturer) AS manufacturer FROM vehicle_events", "vehicle_events"),
    "vehicle_filter_vin": sql("SELECT id, vin FROM vehicle_events WHERE vin IS NOT NULL", "vehicle_events"),
    "vehicle_gear": sql(f"SELECT id, gearPosition AS raw_gear, {_GEAR} AS gearPosition FROM vehicle_events",
                        "vehicle_events"),
    "vehicle_date": sql(f"SELECT id, timestamp, {_DATE} AS date FROM vehicle_events", "vehicle_events"),
    "vehicle_hour": sql(f"SELECT id, timestamp, {_HOUR} AS hour FROM vehicle_events", "vehicle_events"),
    "null_pct": sql(_NULL_PCT, "vehicle_events"),
    "count_by_manufacturer": sql("SELECT manufacturer, count(*) AS vehicles FROM vehicle_clean GROUP BY manufacturer",
                                 "vehicle_clean"),
    "count_by_gear": sql("SELECT gearPosition, count(*) AS vehicles FROM vehicle_clean GROUP BY gearPosition",
                         "vehicle_clean"),
    "event_date_range": sql("SELECT min(date) AS min_date, max(date) AS max_date FROM vehicle_clean",
                            "vehicle_clean"),
    "vehicle_metrics": sql(_VEHICLE_METRICS, "vehicle_clean"),
    "price_category": sql(f"SELECT p_partkey, p_retailprice, {_BAND} AS price_category FROM part"),
    "discount_price": sql("SELECT p_partkey, p_retailprice, p_retailprice * 0.1 AS discount, "
                          "p_retailprice - p_retailprice * 0.1 AS final_price FROM part"),
    "gear_violations": sql(f"SELECT 'raw' AS stage, count(*) FILTER (WHERE {_NOT_NUMERIC}) AS violations "
                           f"FROM vehicle_events UNION ALL SELECT 'clean', count(*) FILTER (WHERE {_NOT_NUMERIC}) "
                           f"FROM vehicle_clean", "vehicle_events", "vehicle_clean"),
    "untrimmed_count": sql(f"SELECT 'raw' AS stage, count(*) FILTER (WHERE {_UNTRIMMED}) AS violations "
                           f"FROM vehicle_events UNION ALL SELECT 'clean', count(*) FILTER (WHERE {_UNTRIMMED}) "
                           f"FROM vehicle_clean", "vehicle_events", "vehicle_clean"),
    "distinct_categories": sql(f"SELECT DISTINCT {_BAND} AS price_category FROM part"),
    "write_partitioned_version": sql(f"SELECT {_VEHICLE_COLS} FROM vehicle_clean", "vehicle_clean"),
    "write_version": sql("SELECT * FROM merged_vertices", "merged_vertices"),
    "save_table": sql("SELECT * FROM all_customers", "all_customers"),
    "empty_table_like": sql("SELECT 'source' AS table_role, count(*) AS row_count, 3 AS column_count FROM all_customers "
                            "UNION ALL SELECT 'empty', 0, 3", "all_customers"),
    "partition_values": sql("SELECT DISTINCT date, hour FROM vehicle_clean", "vehicle_clean"),
    "partition_specs": sql("SELECT date, hour, count(*) AS row_count FROM vehicle_clean GROUP BY date, hour",
                           "vehicle_clean"),
    "publish_partitioned": sql(f"SELECT {_VEHICLE_COLS} FROM vehicle_clean", "vehicle_clean"),
    "rollback_version": sql(f"SELECT {_VEHICLE_COLS} FROM vehicle_clean", "vehicle_clean"),
    "list_partitions": sql("SELECT DISTINCT 'date=' || date || '/hour=' || CAST(hour AS VARCHAR) AS partition "
                           "FROM vehicle_clean", "vehicle_clean"),
    "publish_table": sql("SELECT * FROM merged_vertices", "merged_vertices"),
    "scan_table": sql("SELECT location, count(*) AS customers FROM all_customers GROUP BY location", "all_customers"),
    "scan_sql": sql("SELECT event_type, count(*) AS events, round(sum(value), 6) AS total_value "
                    "FROM events GROUP BY event_type"),
    "scan_json": sql("SELECT * FROM customer"),
    "compare_by_digest": sql("""
SELECT true AS schema_equal, (SELECT count(*) FROM merged_vertices) AS left_rows,
       (SELECT count(*) FROM vertices) AS right_rows,
       (SELECT count(*) FROM (SELECT * FROM merged_vertices EXCEPT ALL SELECT * FROM vertices)) AS left_only,
       (SELECT count(*) FROM (SELECT * FROM vertices EXCEPT ALL SELECT * FROM merged_vertices)) AS right_only""",
                          "merged_vertices", "vertices"),
    "csv_quarantine": sql("""
SELECT 'kept' AS outcome, count(*) AS records, sum(p_size)::BIGINT AS total_size FROM part
WHERE p_partkey % 10 <> 3 AND p_partkey % 25 <> 4
UNION ALL SELECT 'p_size is not int: many', count(*), NULL FROM part WHERE p_partkey % 10 = 3
UNION ALL SELECT 'the line doesn''t have the declared fields', count(*), NULL FROM part WHERE p_partkey % 25 = 4"""),
    "merge_delta": sql("SELECT * FROM merged_edges", "merged_edges"),
    "merge_delta_bucketed": sql("SELECT * FROM merged_edges", "merged_edges"),
    "components_after_merge": sql("SELECT * FROM components", "components"),
    "scan_csv_declared": sql("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"),
    "compare_frames": sql("""
SELECT true AS schema_equal, (SELECT count(*) FROM merged_vertices) AS left_rows,
       (SELECT count(*) FROM vertices) AS right_rows,
       (SELECT count(*) FROM (SELECT * FROM merged_vertices EXCEPT ALL SELECT * FROM vertices)) AS left_only,
       (SELECT count(*) FROM (SELECT * FROM vertices EXCEPT ALL SELECT * FROM merged_vertices)) AS right_only""",
                          "merged_vertices", "vertices"),
    "align_union": sql("""
SELECT customer_id, name, location, CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS category,
       CAST(NULL AS DOUBLE) AS price FROM all_customers
UNION ALL SELECT NULL, name, NULL, product_id, category, price FROM all_products""", "all_customers", "all_products"),
    "build_vertices": sql("SELECT * FROM all_vertices", "all_vertices"),
    "build_edges": sql("SELECT * FROM all_edges", "all_edges"),
    "anti_join_vertices": sql("SELECT * FROM fresh_vertices", "fresh_vertices"),
    "anti_join_edges": sql("SELECT * FROM fresh_edges", "fresh_edges"),
    "merge_vertices": sql("SELECT * FROM merged_vertices", "merged_vertices"),
    "merge_edges": sql("SELECT * FROM merged_edges", "merged_edges"),
    "combine_output": sql(_COMBINED.format(extra_null="", extra_edge="", vertices="merged_vertices"),
                          "merged_vertices", "merged_edges"),
    "split_output": sql("SELECT * FROM merged_vertices", "merged_vertices"),
    "split_output_edges": sql("SELECT * FROM merged_edges", "merged_edges"),
    "graph_totals": sql("SELECT (SELECT count(*) FROM merged_vertices) AS total_vertices, "
                        "(SELECT count(*) FROM merged_edges) AS total_edges", "merged_vertices", "merged_edges"),
    "customers_by_location": sql("SELECT location, count(*) AS customers FROM merged_vertices "
                                 "WHERE vertex_type = 'customer' GROUP BY location", "merged_vertices"),
    "products_by_category": sql("SELECT category, count(*) AS products FROM merged_vertices "
                                "WHERE vertex_type = 'product' GROUP BY category", "merged_vertices"),
    "purchase_date_range": sql("SELECT min(purchase_date) AS min_date, max(purchase_date) AS max_date "
                               "FROM merged_edges WHERE relationship = 'PURCHASED'", "merged_edges"),
    "graph_metrics": sql(_GRAPH_METRICS, "merged_vertices", "merged_edges"),
    "pagerank": sql(_RANKED + "ranked", "ranked"),
    "pagerank_after_merge": sql(_RANKED + "ranked", "ranked"),
    "pagerank_both_directions": sql(_RANKED + "ranked_both", "ranked_both"),
    "connected_components": sql("SELECT * FROM components", "components"),
    "influential_customers": sql(_top("customer"), "ranked"),
    "influential_customers_both": sql(_top("customer", "ranked_both"), "ranked_both"),
    "popular_products": sql(_top("product"), "ranked"),
    "components_many": sql("""
SELECT 'o:' || CAST(o_orderkey AS VARCHAR) AS id,
       min('o:' || CAST(o_orderkey AS VARCHAR)) OVER (PARTITION BY o_custkey) AS component FROM orders"""),
    "table_as_of": sql("""
SELECT nth, id, date, hour, gearPosition FROM vehicle_clean CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(nth)
WHERE nth IN (2, 4) OR (nth = 1) = (date = (SELECT min(date) FROM vehicle_clean))""", "vehicle_clean"),
    "publish_history": sql("""
SELECT nth, CASE WHEN nth = 4 THEN 'rollback' ELSE 'publish' END AS kind,
       CASE nth WHEN 1 THEN 'v1' WHEN 3 THEN 'v3' ELSE 'v2' END AS version,
       count(DISTINCT (date, hour)) AS partitions, count(*) AS row_count, nth = 4 AS served_now
FROM vehicle_clean CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(nth)
WHERE nth IN (2, 4) OR (nth = 1) = (date = (SELECT min(date) FROM vehicle_clean)) GROUP BY nth""", "vehicle_clean"),
    "publish_schema_change": sql(f"SELECT {_VEHICLE_COLS} FROM vehicle_clean", "vehicle_clean"),
    "purchase_graph_etl": sql(_COMBINED.format(
        extra_null=", pagerank, component",
        extra_edge=", CAST(NULL AS DOUBLE) AS pagerank, CAST(NULL AS VARCHAR) AS component",
        vertices="(SELECT v.*, r.pagerank, c.component FROM merged_vertices v "
                 "LEFT JOIN ranked r ON v.id = r.id LEFT JOIN components c ON v.id = c.id)"),
        "merged_vertices", "merged_edges", "ranked", "components"),
    "run_job": sql("SELECT 'vehicle etl' AS name, 'SUCCESS' AS status, count(*) AS processed, "
                   "CAST(NULL AS VARCHAR) AS error_details FROM vehicle_clean", "vehicle_clean"),
    "run_metrics_table": sql("SELECT 'vehicle etl' AS name, 'SUCCESS' AS status, count(*) AS processed, "
                             "CAST(NULL AS VARCHAR) AS error_class FROM vehicle_clean "
                             "UNION ALL SELECT 'vehicle etl (no partitions)', 'FAILED', NULL, 'builtins.ValueError'",
                             "vehicle_clean"),
    "run_business_metrics": sql(_VEHICLE_METRICS, "vehicle_clean"),
    "vehicle_metrics_by_states": sql(_VEHICLE_METRICS, "vehicle_clean"),
    "graph_job_vertices": sql("SELECT * FROM merged_vertices", "merged_vertices"),
    "graph_job_edges": sql("SELECT * FROM merged_edges", "merged_edges"),
    "graph_job_components": sql("SELECT * FROM components", "components"),
    "graph_job_top_customers": sql(_top("customer"), "ranked"),
    "graph_job_top_products": sql(_top("product"), "ranked"),
    "graph_job": sql(_RANKED + "ranked", "ranked"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
