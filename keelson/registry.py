"""Registered queries: one per operator of the survey's inventory.

Each takes ``(spark, sf_dir)``, reads the driver's tables in full (through
the adapters) and returns a DataFrame whose column names match the SQL
oracle in ``keelson.oracle``. Sinks write into a fresh path under the shared
folder and return what they read back. Doubles that come out of sums or
divisions are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import (
    discount,
    epoch_ms_date,
    epoch_ms_hour,
    final_price,
    is_not_numeric,
    normalize_gear,
    price_band,
    trim_spaces,
)
from keelson.operators import quality as Q
from keelson.operators.compare import compare_by_digest, compare_frames
from keelson.operators.components import components_after_merge, connected_components
from keelson.operators.graph import (
    CUSTOMER,
    PRODUCT,
    build_edges,
    build_vertices,
    merged_graph,
)
from keelson.operators.merge import (
    align_union,
    combine_output,
    merge_edges,
    merge_vertices,
    new_rows,
    split_output,
)
from keelson.operators.pagerank import RankState, pagerank, pagerank_after_merge, ranked_vertices, top_k
from keelson.operators.vehicle import clean_vehicle_events
from keelson.plans.graph_job import RESULT_TABLES, TABLE_DEFAULTS, GraphAnalytics, PurchaseGraphJob, enriched_output
from keelson.plans.job import run_job
from keelson.plans.vehicle_job import VehicleJob
from keelson.session import scratch_path, store, unique_name
from keelson.sinks import versioned as V
from keelson.sinks.delta import DeltaVersions
from keelson.sinks.served import PublishLog, create_served
from keelson.sources import adapters as A
from keelson.sources.quarantine import read_csv_checked
from keelson.sources.tables import create_csv_table, read_files, register_view, scan_sql, scan_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Fixed values used by the registered queries.
TIME_ZONE = "UTC"                      # event date/hour zone (explicit, not the session's)
PRICE_LOW_BELOW, PRICE_MEDIUM_BELOW = 933.0, 966.0   # bands over p_retailprice 900..1000
PARTITION_COLUMNS = ["date", "hour"]
TOP_K = 5
DIGITS = 6


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def _r(c: str, digits: int = DIGITS):
    return F.round(F.col(c), digits).alias(c)


# ---------------------------------------------------------------- inputs

# What several queries of one session read is made once and stored: (application, data, what) -> it.
_MADE: dict[tuple[str, str, str], object] = {}


def _once(spark, sf, what: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def vehicle_events(spark: SparkSession, sf: str) -> DataFrame:
    return A.vehicle_events(A.read_table(spark, sf, "events"))


def vehicle_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_vehicle_events(vehicle_events(spark, sf), TIME_ZONE)


def retail_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The graph job's six inputs; lineitem and orders are joined once a session, for existing purchases and batch."""
    dated = _once(spark, sf, "purchases", lambda: store(
        A.dated_purchases(A.read_table(spark, sf, "lineitem"), A.read_table(spark, sf, "orders")), "purchases").df)
    return A.retail_inputs(spark, sf, dated)


def graph(spark: SparkSession, sf: str):
    return merged_graph(retail_inputs(spark, sf))


# ---------------------------------------------------------------- vehicle transform

@query("vehicle_etl")
def q_vehicle_etl(spark, sf):
    return vehicle_clean(spark, sf)


@query("vehicle_trim")
def q_vehicle_trim(spark, sf):
    return vehicle_events(spark, sf).select("id", trim_spaces("manufacturer").alias("manufacturer"))


@query("vehicle_filter_vin")
def q_vehicle_filter_vin(spark, sf):
    return vehicle_events(spark, sf).filter(F.col("vin").isNotNull()).select("id", "vin")


@query("vehicle_gear")
def q_vehicle_gear(spark, sf):
    return vehicle_events(spark, sf).select(
        "id", F.col("gearPosition").alias("raw_gear"), normalize_gear("gearPosition").alias("gearPosition"))


@query("vehicle_date")
def q_vehicle_date(spark, sf):
    return vehicle_events(spark, sf).select("id", "timestamp", epoch_ms_date("timestamp", TIME_ZONE).alias("date"))


@query("vehicle_hour")
def q_vehicle_hour(spark, sf):
    return vehicle_events(spark, sf).select("id", "timestamp", epoch_ms_hour("timestamp", TIME_ZONE).alias("hour"))


# ---------------------------------------------------------------- quality metrics

@query("null_pct")
def q_null_pct(spark, sf):
    return Q.null_percentages(vehicle_events(spark, sf)).select("column_name", _r("null_pct"))


@query("count_by_manufacturer")
def q_count_by_manufacturer(spark, sf):
    return Q.count_by(vehicle_clean(spark, sf), "manufacturer", "vehicles")


@query("count_by_gear")
def q_count_by_gear(spark, sf):
    return Q.count_by(vehicle_clean(spark, sf), "gearPosition", "vehicles")


@query("event_date_range")
def q_event_date_range(spark, sf):
    return Q.value_range(vehicle_clean(spark, sf), "date", "min_date", "max_date")


@query("vehicle_metrics")
def q_vehicle_metrics(spark, sf):
    return Q.vehicle_metrics(vehicle_clean(spark, sf)).select("metric", "group_key", _r("value"), "text_value")


def _parts(spark, sf):
    return A.read_table(spark, sf, "part")


@query("price_category")
def q_price_category(spark, sf):
    return _parts(spark, sf).select(
        "p_partkey", "p_retailprice",
        price_band("p_retailprice", PRICE_LOW_BELOW, PRICE_MEDIUM_BELOW).alias("price_category"))


@query("discount_price")
def q_discount_price(spark, sf):
    return _parts(spark, sf).select(
        "p_partkey", "p_retailprice", discount("p_retailprice").alias("discount"),
        final_price("p_retailprice").alias("final_price"))


@query("gear_violations")
def q_gear_violations(spark, sf):
    raw = Q.gear_violations(vehicle_events(spark, sf)).select(F.lit("raw").alias("stage"), "violations")
    clean = Q.gear_violations(vehicle_clean(spark, sf)).select(F.lit("clean").alias("stage"), "violations")
    return raw.unionByName(clean)


@query("untrimmed_count")
def q_untrimmed_count(spark, sf):
    raw = Q.untrimmed_count(vehicle_events(spark, sf)).select(F.lit("raw").alias("stage"), "violations")
    clean = Q.untrimmed_count(vehicle_clean(spark, sf)).select(F.lit("clean").alias("stage"), "violations")
    return raw.unionByName(clean)


@query("distinct_categories")
def q_distinct_categories(spark, sf):
    return q_price_category(spark, sf).select("price_category").distinct()


# ---------------------------------------------------------------- versioned tables

def _written_vehicle_version(spark, sf):
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, "vehicles")
    V.write_version(clean, base, "v001", PARTITION_COLUMNS)
    return clean, base


@query("write_partitioned_version")
def q_write_partitioned_version(spark, sf):
    clean, base = _written_vehicle_version(spark, sf)
    return V.read_version(spark, base, "v001", clean.schema)


@query("write_version")
def q_write_version(spark, sf):
    g = graph(spark, sf)
    base = scratch_path(spark, "vertices")
    V.write_version(g.vertices, base, "v001")
    return V.read_version(spark, base, "v001")


@query("save_table")
def q_save_table(spark, sf):
    customers = A.all_customers(A.read_table(spark, sf, "customer"))
    name = f"default.{unique_name('customers')}"
    return V.save_table(customers, name, scratch_path(spark, "customers_table"))


@query("empty_table_like")
def q_empty_table_like(spark, sf):
    customers = A.all_customers(A.read_table(spark, sf, "customer"))
    src = V.save_table(customers, f"default.{unique_name('customers')}", scratch_path(spark, "customers_table"))
    empty = V.create_empty_table_like(spark, src, f"default.{unique_name('new_customers')}",
                                      scratch_path(spark, "empty_table"))
    def described(df: DataFrame, role: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(role).alias("table_role"), "row_count", F.lit(len(df.columns)).alias("column_count"))

    return described(src, "source").unionByName(described(empty, "empty"))


@query("partition_values")
def q_partition_values(spark, sf):
    clean, base = _written_vehicle_version(spark, sf)
    return V.partition_values(V.read_version(spark, base, "v001", clean.schema), PARTITION_COLUMNS)


@query("partition_specs")
def q_partition_specs(spark, sf):
    clean, base = _written_vehicle_version(spark, sf)
    return V.partition_specs(V.read_version(spark, base, "v001", clean.schema), PARTITION_COLUMNS)


def _first_day(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date") == df.select(F.min("date")).scalar())


def _vehicle_table(spark, clean, base):
    name = f"default.{unique_name('processed_vehicles')}"
    create_served(spark, name, clean.schema, PARTITION_COLUMNS)
    return name


@query("publish_partitioned")
def q_publish_partitioned(spark, sf):
    """v1 = the first day's load, v2 = the full load; the table serves v2."""
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, "published")
    name = _vehicle_table(spark, clean, base)
    V.write_version(_first_day(clean), base, "v1", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v1")
    V.write_version(clean, base, "v2", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v2")
    return scan_table(spark, name)


@query("rollback_version")
def q_rollback_version(spark, sf):
    """v1 = full load, v2 = a bad load (first day only), then roll back to v1:
    v2's publish must drop v1's other partitions and the rollback restore them."""
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, "rollback")
    name = _vehicle_table(spark, clean, base)
    V.write_version(clean, base, "v1", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v1")
    V.write_version(_first_day(clean), base, "v2", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v2")
    V.publish_partitioned(spark, name, base, "v1")
    return scan_table(spark, name)


@query("publish_schema_change")
def q_publish_schema_change(spark, sf):
    """v1 without the model column, v2 with it: the table must show v2's columns."""
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, "schema_change")
    first = _first_day(clean).drop("model")
    name = f"default.{unique_name('processed_vehicles')}"
    create_served(spark, name, first.schema, PARTITION_COLUMNS)
    V.write_version(first, base, "v1", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v1")
    V.write_version(clean, base, "v2", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v2")
    return scan_table(spark, name)


@query("vehicle_metrics_by_states")
def q_vehicle_metrics_by_states(spark, sf):
    """v1 = all days but the last, v2 = the last merged in: v2's metrics from v1's kept states and one new segment."""
    clean = vehicle_clean(spark, sf)
    last = clean.select(F.max("date")).scalar()
    events = DeltaVersions(spark, scratch_path(spark, "event_versions"), ["id"])
    events.create(clean.filter(F.col("date") < last), "v1")
    make = lambda df: Q.vehicle_states(df, by=PARTITION_COLUMNS)
    events.states("v1", "vehicle", make)
    events.merge("v1", "v2", clean.filter(F.col("date") == last))
    return Q.vehicle_metrics_of(events.states("v2", "vehicle", make)).select("metric", "group_key", _r("value"), "text_value")


def _published_thrice(spark, sf, label: str) -> tuple[PublishLog, str]:
    """v1 = first day, v2 = all days, v3 = all but the first, then back to v2; all of it logged."""
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, label)
    name, log = _vehicle_table(spark, clean, base), PublishLog(spark, scratch_path(spark, f"{label}_log"))
    first = _first_day(clean)
    rest = clean.filter(F.col("date") > clean.select(F.min("date")).scalar())
    for version, rows in (("v1", first), ("v2", clean), ("v3", rest)):
        V.write_version(rows, base, version, PARTITION_COLUMNS)
        log.publish(name, base, version)
    log.roll_back(name)
    return log, name


@query("table_as_of")
def q_table_as_of(spark, sf):
    """The rows that the table showed at each of four times: three publishes and a rollback."""
    log, name = _published_thrice(spark, sf, "as_of")
    out = None
    for row in log.history(name).orderBy("nth").collect():
        shown = log.as_of(name, row["published_at"]).select(F.lit(row["nth"]).alias("nth"), "id", "date", "hour", "gearPosition")
        out = shown if out is None else out.unionByName(shown)
    return out


@query("publish_history")
def q_publish_history(spark, sf):
    log, name = _published_thrice(spark, sf, "history")
    return log.history(name).select(
        "nth", "kind", "version", "partitions", "row_count", F.col("served_until").isNull().alias("served_now"))


@query("list_partitions")
def q_list_partitions(spark, sf):
    clean = vehicle_clean(spark, sf)
    base = scratch_path(spark, "listed")
    name = _vehicle_table(spark, clean, base)
    V.write_version(clean, base, "v1", PARTITION_COLUMNS)
    V.publish_partitioned(spark, name, base, "v1")
    return V.list_partitions(spark, name)


@query("publish_table")
def q_publish_table(spark, sf):
    """v1 without the price column, v2 with it: the table must show v2's schema."""
    g = graph(spark, sf)
    base = scratch_path(spark, "vertices")
    name = f"default.{unique_name('processed_vertices')}"
    V.write_version(g.vertices.drop("price"), base, "v1")
    V.publish_table(spark, name, base, "v1")
    V.write_version(g.vertices, base, "v2")
    V.publish_table(spark, name, base, "v2")
    return scan_table(spark, name)


# ---------------------------------------------------------------- scans

@query("scan_table")
def q_scan_table(spark, sf):
    customers = A.all_customers(A.read_table(spark, sf, "customer"))
    name = f"default.{unique_name('customers')}"
    V.save_table(customers, name, scratch_path(spark, "customers_table"))
    return scan_table(spark, name).groupBy("location").agg(F.count(F.lit(1)).alias("customers"))


@query("scan_sql")
def q_scan_sql(spark, sf):
    view = unique_name("events")
    register_view(A.read_table(spark, sf, "events"), view)
    return scan_sql(spark, "SELECT event_type, count(*) AS events, round(sum(value), 6) AS total_value "
                           "FROM IDENTIFIER(:source) GROUP BY event_type", {"source": view})


@query("scan_json")
def q_scan_json(spark, sf):
    customer = A.read_table(spark, sf, "customer")
    path = scratch_path(spark, "customer_json")
    customer.write.mode("overwrite").json(path)
    return read_files(spark, path, "json", schema=customer.schema)


PART_DDL = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
            "p_size INT, p_retailprice DOUBLE")


@query("scan_csv_declared")
def q_scan_csv_declared(spark, sf):
    part = A.read_table(spark, sf, "part")
    path = scratch_path(spark, "part_csv")
    part.write.mode("overwrite").option("header", "true").csv(path)
    return create_csv_table(spark, f"default.{unique_name('part_csv')}", PART_DDL, path)


@query("compare_frames")
def q_compare_frames(spark, sf):
    inputs = A.retail_inputs(spark, sf)
    existing = build_vertices(inputs["customers"], inputs["products"])
    merged = merge_vertices(existing, build_vertices(inputs["new_customers"], inputs["new_products"]))
    return compare_frames(merged, existing)


@query("compare_by_digest")
def q_compare_by_digest(spark, sf):
    inputs = A.retail_inputs(spark, sf)
    existing = store(build_vertices(inputs["customers"], inputs["products"]), "existing").df
    merged = store(merge_vertices(existing, build_vertices(inputs["new_customers"], inputs["new_products"])), "merged").df
    return compare_by_digest(merged, existing)


@query("csv_quarantine")
def q_csv_quarantine(spark, sf):
    """Parts as CSV lines, one size in ten written as a word and one line in 25 cut short; what is kept and why not."""
    part = A.read_table(spark, sf, "part")
    size = F.when(F.col("p_partkey") % 10 == 3, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    whole = F.concat_ws(",", "p_partkey", "p_name", "p_brand", "p_type", size, "p_retailprice")
    path = scratch_path(spark, "part_lines")
    part.select(F.when(F.col("p_partkey") % 25 == 4, F.concat_ws(",", "p_partkey", "p_name")).otherwise(whole).alias("value")).write.text(path)
    found = read_csv_checked(spark, path, PART_DDL, header=False)
    kept = found.good.agg(F.count(F.lit(1)).alias("records"), F.sum("p_size").alias("total_size")).select(
        F.lit("kept").alias("outcome"), "records", "total_size")
    bad = found.bad.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("records")).withColumn(
        "total_size", F.lit(None).cast("long"))
    return kept.unionByName(bad)


# ---------------------------------------------------------------- graph model and merges

@query("align_union")
def q_align_union(spark, sf):
    return align_union(A.all_customers(A.read_table(spark, sf, "customer")), A.all_products(_parts(spark, sf)))


@query("build_vertices")
def q_build_vertices(spark, sf):
    return build_vertices(A.all_customers(A.read_table(spark, sf, "customer")), A.all_products(_parts(spark, sf)))


@query("build_edges")
def q_build_edges(spark, sf):
    return build_edges(A.all_purchases(A.read_table(spark, sf, "lineitem"), A.read_table(spark, sf, "orders")))


@query("anti_join_vertices")
def q_anti_join_vertices(spark, sf):
    i = A.retail_inputs(spark, sf)
    return new_rows(build_vertices(i["new_customers"], i["new_products"]),
                    build_vertices(i["customers"], i["products"]), ["id"])


@query("anti_join_edges")
def q_anti_join_edges(spark, sf):
    i = retail_inputs(spark, sf)
    return new_rows(build_edges(i["new_purchases"]), build_edges(i["purchases"]), ["src", "dst", "relationship"])


@query("merge_vertices")
def q_merge_vertices(spark, sf):
    i = A.retail_inputs(spark, sf)
    return merge_vertices(build_vertices(i["customers"], i["products"]),
                          build_vertices(i["new_customers"], i["new_products"]))


@query("merge_edges")
def q_merge_edges(spark, sf):
    i = retail_inputs(spark, sf)
    return merge_edges(build_edges(i["purchases"]), build_edges(i["new_purchases"]))


def _merged_delta(spark, sf, buckets: int) -> DataFrame:
    """Version v1 of the edges, and v2 with what the batch adds: v2's rows."""
    i = retail_inputs(spark, sf)
    edges = DeltaVersions(spark, scratch_path(spark, "edge_versions"), ["src", "dst", "relationship"], buckets)
    edges.create(build_edges(i["purchases"]), "v1")
    edges.merge("v1", "v2", build_edges(i["new_purchases"]))
    return edges.read("v2")


@query("merge_delta")
def q_merge_delta(spark, sf):
    return _merged_delta(spark, sf, 0)


@query("merge_delta_bucketed")
def q_merge_delta_bucketed(spark, sf):
    return _merged_delta(spark, sf, 8)


@query("combine_output")
def q_combine_output(spark, sf):
    g = graph(spark, sf)
    return combine_output(g.vertices, g.edges)


@query("split_output")
def q_split_output(spark, sf):
    return split_output(q_combine_output(spark, sf))[0]


@query("split_output_edges")
def q_split_output_edges(spark, sf):
    return split_output(q_combine_output(spark, sf))[1]


@query("graph_totals")
def q_graph_totals(spark, sf):
    g = graph(spark, sf)
    return spark.range(1).select(
        g.vertices.select(F.count(F.lit(1))).scalar().alias("total_vertices"),
        g.edges.select(F.count(F.lit(1))).scalar().alias("total_edges"))


@query("customers_by_location")
def q_customers_by_location(spark, sf):
    v = graph(spark, sf).vertices
    return Q.count_by(v.filter(F.col("vertex_type") == CUSTOMER), "location", "customers")


@query("products_by_category")
def q_products_by_category(spark, sf):
    v = graph(spark, sf).vertices
    return Q.count_by(v.filter(F.col("vertex_type") == PRODUCT), "category", "products")


@query("purchase_date_range")
def q_purchase_date_range(spark, sf):
    e = graph(spark, sf).edges
    return Q.value_range(e.filter(F.col("relationship") == "PURCHASED"), "purchase_date", "min_date", "max_date")


@query("graph_metrics")
def q_graph_metrics(spark, sf):
    g = graph(spark, sf)
    return Q.graph_metrics(g.vertices, g.edges)


# ---------------------------------------------------------------- graph analytics

def _stored_graph(spark, sf):
    return _once(spark, sf, "graph", lambda: graph(spark, sf).materialized(edges_lie_stored=True).checked())


def _ranked(spark, sf, direction: str = "out") -> DataFrame:
    def make() -> DataFrame:
        g = _stored_graph(spark, sf)
        return store(ranked_vertices(g.vertices, pagerank(g.vertices, g.edges, direction=direction)), "ranks").df

    return _once(spark, sf, f"ranks {direction}", make)


def _components(spark, sf) -> DataFrame:
    def make() -> DataFrame:
        g = _stored_graph(spark, sf)
        return store(g.vertices.select("id", "vertex_type").join(connected_components(g.vertices, g.edges), "id"), "labels").df

    return _once(spark, sf, "components", make)


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.select("id", "vertex_type", _r("pagerank"))


@query("pagerank")
def q_pagerank(spark, sf):
    return _rounded(_ranked(spark, sf))


@query("pagerank_both_directions")
def q_pagerank_both(spark, sf):
    return _rounded(_ranked(spark, sf, "both"))


@query("connected_components")
def q_connected_components(spark, sf):
    return _components(spark, sf)


@query("components_after_merge")
def q_components_after_merge(spark, sf):
    """Components of the existing graph, then only what the batch changes."""
    i = retail_inputs(spark, sf)
    vertices, edges = (store(df, "existing").df for df in (
        build_vertices(i["customers"], i["products"]), build_edges(i["purchases"])))
    labels = connected_components(vertices, edges)
    new_vertices, new_edges = build_vertices(i["new_customers"], i["new_products"]), build_edges(i["new_purchases"])
    found = components_after_merge(labels, edges, new_vertices, new_edges)
    types = vertices.select("id", "vertex_type").unionByName(new_vertices.select("id", "vertex_type")).distinct()
    return types.join(found, "id")


@query("pagerank_after_merge")
def q_pagerank_after_merge(spark, sf):
    """Ranks of the existing graph, then only what the batch changes."""
    i = retail_inputs(spark, sf)
    vertices, edges = (store(df, "existing").df for df in (
        build_vertices(i["customers"], i["products"]), build_edges(i["purchases"])))
    state = RankState()
    pagerank(vertices, edges, state=state)
    new_vertices, all_new = build_vertices(i["new_customers"], i["new_products"]), build_edges(i["new_purchases"])
    fresh = new_rows(store(all_new, "batch").df, edges, ["src", "dst", "relationship"])
    found = pagerank_after_merge(state, edges, new_vertices, fresh)
    types = vertices.select("id", "vertex_type").unionByName(new_vertices.select("id", "vertex_type")).distinct()
    return _rounded(types.join(found, "id"))


@query("components_many")
def q_components_many(spark, sf):
    """About one component a customer, each a long path: orders chained per customer."""
    return connected_components(*A.order_chains(A.read_table(spark, sf, "orders")))


@query("influential_customers")
def q_influential_customers(spark, sf):
    return _rounded(top_k(_ranked(spark, sf), CUSTOMER, TOP_K))


@query("influential_customers_both")
def q_influential_customers_both(spark, sf):
    """Both directions: there the customers' ranks differ."""
    return _rounded(top_k(_ranked(spark, sf, "both"), CUSTOMER, TOP_K))


@query("popular_products")
def q_popular_products(spark, sf):
    return _rounded(top_k(_ranked(spark, sf), PRODUCT, TOP_K))


@query("purchase_graph_etl")
def q_purchase_graph_etl(spark, sf):
    g = _stored_graph(spark, sf)
    return enriched_output(g, GraphAnalytics(_rounded(_ranked(spark, sf)), _components(spark, sf), None, None))


# ---------------------------------------------------------------- job runner

def _vehicle_job_props(spark, sf) -> dict[str, str]:
    view = unique_name("vehicle_events")
    register_view(vehicle_events(spark, sf), view)
    root = scratch_path(spark, "vehicle_job")
    return {
        "source-table": view,
        "target-table": f"default.{unique_name('processed_vehicles')}",
        "base-path": f"{root}/data",
        "version": "v001",
        "partition-columns": "date,hour",
        "time-zone": TIME_ZONE,
        "create-target": "true",
        "metrics-name": "vehicle etl",
        "metrics-reporter": "table",
        "metrics-path": f"{root}/metrics",
    }


@query("run_job")
def q_run_job(spark, sf):
    props = _vehicle_job_props(spark, sf)
    run = run_job(spark, VehicleJob(), props)
    return spark.createDataFrame(
        [(run.name, run.status, run.record_counts.get("processed"), run.error_details)],
        "name string, status string, processed bigint, error_details string")


@query("run_metrics_table")
def q_run_metrics_table(spark, sf):
    """Two runs into one metrics table: a good one and one without partition columns."""
    props = _vehicle_job_props(spark, sf)
    run_job(spark, VehicleJob(), props)
    bad = {**props, "partition-columns": " ", "metrics-name": "vehicle etl (no partitions)"}
    run_job(spark, VehicleJob(), bad, raise_errors=False)
    runs = spark.read.parquet(f"{props['metrics-path']}/runs")
    return runs.select("name", "status", F.col("record_counts")["processed"].alias("processed"),
                       F.split(F.col("error_details"), ":")[0].alias("error_class"))


@query("run_business_metrics")
def q_run_business_metrics(spark, sf):
    props = _vehicle_job_props(spark, sf)
    run_job(spark, VehicleJob(), props)
    return spark.read.parquet(f"{props['metrics-path']}/business_metrics").select(
        "metric", "group_key", _r("value"), "text_value")


def _graph_job(spark, sf) -> dict[str, str]:
    """The graph job's published tables, by result; the job runs once a session."""
    return _once(spark, sf, "graph job", lambda: _run_graph_job(spark, sf))


def _run_graph_job(spark, sf) -> dict[str, str]:
    """Run the graph job on six catalog inputs; the name of each published table."""
    inputs = retail_inputs(spark, sf)
    props = {}
    for key, (prop, _default) in TABLE_DEFAULTS.items():
        view = unique_name(key)
        register_view(inputs[key], view)
        props[prop] = view
    root = scratch_path(spark, "graph_job")
    names = {"vertices": "target-vertices-table", "edges": "target-edges-table"} | {
        label: prop for label, (prop, _default) in RESULT_TABLES.items()}
    tables = {label: f"default.{unique_name(label)}" for label in names}
    props.update({prop: tables[label] for label, prop in names.items()})
    props.update({"base-path": f"{root}/data", "version": "v001", "top-k": str(TOP_K),
                  "metrics-reporter": "table", "metrics-path": f"{root}/metrics"})
    run_job(spark, PurchaseGraphJob(), props)
    return tables


@query("graph_job")
def q_graph_job(spark, sf):
    """The ranks that the graph job publishes."""
    return _rounded(scan_table(spark, _graph_job(spark, sf)["pagerank"]))


@query("graph_job_vertices")
def q_graph_job_vertices(spark, sf):
    return scan_table(spark, _graph_job(spark, sf)["vertices"])


@query("graph_job_edges")
def q_graph_job_edges(spark, sf):
    return scan_table(spark, _graph_job(spark, sf)["edges"])


@query("graph_job_components")
def q_graph_job_components(spark, sf):
    return scan_table(spark, _graph_job(spark, sf)["components"])


@query("graph_job_top_customers")
def q_graph_job_top_customers(spark, sf):
    return _rounded(scan_table(spark, _graph_job(spark, sf)["top_customers"]))


@query("graph_job_top_products")
def q_graph_job_top_products(spark, sf):
    return _rounded(scan_table(spark, _graph_job(spark, sf)["top_products"]))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)
