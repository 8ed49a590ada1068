"""Customer-purchase graph job: build vertices and edges, merge the new
batch insert-only, compute PageRank, connected components and top-k once,
and publish every result as a versioned table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keelson.operators.components import connected_components
from keelson.operators.graph import CUSTOMER, PRODUCT, PurchaseGraph, merged_graph
from keelson.operators.merge import combine_output, split_output
from keelson.operators.pagerank import DEFAULT_ITERATIONS, DEFAULT_RESET, pagerank, ranked_vertices, top_k
from keelson.operators.quality import graph_metrics
from keelson.session import store
from keelson.sinks.versioned import new_version, publish_table, read_version, write_version
from keelson.sources.tables import scan_table

# Property names and defaults of the reference job.
TABLE_DEFAULTS = {
    "customers": ("customers-table", "retail.customers"),
    "products": ("products-table", "retail.products"),
    "purchases": ("purchases-table", "retail.purchases"),
    "new_customers": ("new-customers-table", "retail.new_customers"),
    "new_products": ("new-products-table", "retail.new_products"),
    "new_purchases": ("new-purchases-table", "retail.new_purchases"),
}
DEFAULT_VERTICES_TABLE = "retail.processed_vertices"
DEFAULT_EDGES_TABLE = "retail.processed_edges"
# Every result is published: property and default name of each table.
RESULT_TABLES = {
    "pagerank": ("pagerank-table", "retail.pagerank"),
    "components": ("components-table", "retail.components"),
    "top_customers": ("top-customers-table", "retail.top_customers"),
    "top_products": ("top-products-table", "retail.top_products"),
}
DEFAULT_TOP_K = 5


@dataclass(frozen=True)
class GraphAnalytics:
    ranks: DataFrame        # id, vertex_type, pagerank
    components: DataFrame   # id, vertex_type, component
    influential: DataFrame  # top-k customers
    popular: DataFrame      # top-k products


def analyse(graph: PurchaseGraph, k: int = DEFAULT_TOP_K, iterations: int = DEFAULT_ITERATIONS,
            reset: float = DEFAULT_RESET, direction: str = "out") -> GraphAnalytics:
    """PageRank (stored once, in the shared folder), components, top-k.

    ``graph`` should be stored: both algorithms read it. The job passes the
    versions it has just written."""
    ranks = store(ranked_vertices(graph.vertices, pagerank(
        graph.vertices, graph.edges, iterations, reset, direction=direction)), "ranks").df
    comps = graph.vertices.select("id", "vertex_type").join(
        connected_components(graph.vertices, graph.edges), "id")
    return GraphAnalytics(ranks, comps, top_k(ranks, CUSTOMER, k), top_k(ranks, PRODUCT, k))


def enriched_output(graph: PurchaseGraph, analytics: GraphAnalytics) -> DataFrame:
    """Tagged vertex/edge union whose vertex rows carry pagerank and component."""
    v = (graph.vertices
         .join(analytics.ranks.select("id", "pagerank"), "id", "left")
         .join(analytics.components.select("id", "component"), "id", "left"))
    return combine_output(v, graph.edges)


class PurchaseGraphJob:
    """Properties: the six *-table names, target-vertices-table,
    target-edges-table, base-path, version, top-k (5),
    pagerank-iterations (10), reset-probability (0.15),
    pagerank-direction (out | both), pagerank-table, components-table,
    top-customers-table and top-products-table."""

    def inputs(self, spark: SparkSession, props: dict[str, str]) -> dict[str, DataFrame]:
        return {key: scan_table(spark, props.get(prop, default))
                for key, (prop, default) in TABLE_DEFAULTS.items()}

    def graph(self, spark: SparkSession, props: dict[str, str]) -> PurchaseGraph:
        return merged_graph(self.inputs(spark, props))

    def logic(self, spark: SparkSession, props: dict[str, str]) -> DataFrame:
        g = self.graph(spark, props)
        return combine_output(g.vertices, g.edges)

    def output(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> dict[str, int]:
        if "base-path" not in props:
            raise ValueError("base-path must be specified")
        base = props["base-path"].rstrip("/")
        if not props.get("version"):
            props["version"] = new_version()  # run_job hands metrics() the same dict
        version = props["version"]
        vertices, edges = split_output(df)
        counts: dict[str, int] = {}
        for label, frame, table_prop, default in (
            ("vertices", vertices, "target-vertices-table", DEFAULT_VERTICES_TABLE),
            ("edges", edges, "target-edges-table", DEFAULT_EDGES_TABLE),
        ):
            obs = Observation(f"graph_{label}")
            write_version(frame, f"{base}/{label}", version, observation=obs)
            publish_table(spark, props.get(table_prop, default), f"{base}/{label}", version)
            counts[label] = int(obs.get["rows"])
        # analytics run on the written versions, so the merges are not recomputed
        g = PurchaseGraph(read_version(spark, f"{base}/vertices", version),
                          read_version(spark, f"{base}/edges", version)).checked()
        a = analyse(g, int(props.get("top-k", DEFAULT_TOP_K)),
                    int(props.get("pagerank-iterations", DEFAULT_ITERATIONS)),
                    float(props.get("reset-probability", DEFAULT_RESET)),
                    props.get("pagerank-direction", "out"))
        frames = {"pagerank": a.ranks, "components": a.components,
                  "top_customers": a.influential, "top_products": a.popular}
        for label, frame in frames.items():
            table_prop, default = RESULT_TABLES[label]
            write_version(frame, f"{base}/{label}", version)
            publish_table(spark, props.get(table_prop, default), f"{base}/{label}", version)
        counts["processed"] = counts["vertices"] + counts["edges"]
        return counts

    def metrics(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> DataFrame:
        """Graph metrics; after ``output`` they read the versions just
        written instead of re-running the merge joins."""
        if props.get("base-path") and props.get("version"):
            base = props["base-path"].rstrip("/")
            vertices = read_version(spark, f"{base}/vertices", props["version"])
            edges = read_version(spark, f"{base}/edges", props["version"])
        else:
            vertices, edges = split_output(df)
        return graph_metrics(vertices, edges)
