"""Purchase graph model: vertices from customers and products, edges from
purchases. Two DataFrames; no graph object or GraphX dependency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.merge import align_union, merge_edges, merge_vertices
from keelson.session import Stored, store

# vertex/edge tags and id namespaces. Customer and product ids
# come from different key spaces, so each vertex id carries its kind.
CUSTOMER, PRODUCT, PURCHASED = "customer", "product", "PURCHASED"
CUSTOMER_PREFIX, PRODUCT_PREFIX = "c:", "p:"


def _vertex_id(raw: Column, prefix: str | None) -> Column:
    return raw if prefix is None else F.concat(F.lit(prefix), raw.cast("string"))


def customer_vertices(customers: DataFrame, key: str = "customer_id",
                      prefix: str | None = CUSTOMER_PREFIX) -> DataFrame:
    cols = [(_vertex_id(F.col(key), prefix).alias("id") if c == key else F.col(c)) for c in customers.columns]
    return customers.select(*cols, F.lit(CUSTOMER).alias("vertex_type"))


def product_vertices(products: DataFrame, key: str = "product_id",
                     prefix: str | None = PRODUCT_PREFIX) -> DataFrame:
    cols = [(_vertex_id(F.col(key), prefix).alias("id") if c == key else F.col(c)) for c in products.columns]
    return products.select(*cols, F.lit(PRODUCT).alias("vertex_type"))


def build_vertices(customers: DataFrame, products: DataFrame, namespaced: bool = True) -> DataFrame:
    """customers ∪ products as vertices (id, own attributes, vertex_type)."""
    cp = CUSTOMER_PREFIX if namespaced else None
    pp = PRODUCT_PREFIX if namespaced else None
    return align_union(customer_vertices(customers, prefix=cp), product_vertices(products, prefix=pp))


def build_edges(purchases: DataFrame, namespaced: bool = True,
                src_key: str = "customer_id", dst_key: str = "product_id") -> DataFrame:
    """purchases -> PURCHASED edges customer -> product; other columns kept."""
    cp = CUSTOMER_PREFIX if namespaced else None
    pp = PRODUCT_PREFIX if namespaced else None
    cols = []
    for c in purchases.columns:
        if c == src_key:
            cols.append(_vertex_id(F.col(c), cp).alias("src"))
        elif c == dst_key:
            cols.append(_vertex_id(F.col(c), pp).alias("dst"))
        else:
            cols.append(F.col(c))
    return purchases.select(*cols, F.lit(PURCHASED).alias("relationship"))


@dataclass(frozen=True)
class PurchaseGraph:
    vertices: DataFrame
    edges: DataFrame

    def materialized(self, edges_lie_stored: bool = False) -> "PurchaseGraph":
        """Both frames stored in the shared folder, so several analyses read
        them instead of re-running the build and merge plans. ``edges_lie_stored``: the edges are rows of
        stored tables already (a merge stores its new rows), so they aren't written once more."""
        return PurchaseGraph(store(self.vertices, "vertices").df,
                             self.edges if edges_lie_stored else store(self.edges, "edges").df)

    def checked(self) -> "PurchaseGraph":
        """The graph itself, if no vertex id stands twice; else an error that names one.

        One partial-aggregated pass over the ids: call it on stored vertices.
        """
        twice = self.vertices.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id").first()
        if twice is not None:
            raise ValueError(f"vertex id {twice[0]!r} occurs more than once")
        return self


def merged_graph(inputs: dict[str, DataFrame], namespaced: bool = True) -> PurchaseGraph:
    """Existing graph merged insert-only with the new batch.

    ``inputs`` holds customers, products, purchases and their ``new_*``.
    """
    vertices = build_vertices(inputs["customers"], inputs["products"], namespaced)
    new_vertices = build_vertices(inputs["new_customers"], inputs["new_products"], namespaced)
    edges = build_edges(inputs["purchases"], namespaced)
    new_edges = build_edges(inputs["new_purchases"], namespaced)
    return PurchaseGraph(merge_vertices(vertices, new_vertices), merge_edges(edges, new_edges))


def numbered(ids: DataFrame, label: str, first: int = 0) -> Stored:
    """(id, n): each distinct id with a long integer from ``first`` on, in the order of the ids and with gaps.

    One range sort of |V| ids. Distinct ids have one order, so a task that is repeated gives the same numbers.
    """
    ordered = ids.select("id").distinct().orderBy("id")
    return store(ordered.select("id", (F.lit(first) + F.monotonically_increasing_id()).alias("n")), label)


# With more ids than this, they are dealt by hash to be joined: each task keeps its share of them as a table, and the
# edges need no sort. With fewer, Spark broadcasts them or not, by their stored size.
DEALT_IDS = 100_000


def numbered_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(src, dst) as the numbers that ``ids`` (id, n), distinct and stored, gives them, parallel edges kept.

    Edges with an end that is no vertex are left out, as a graph made of
    these two frames would. What follows moves two longs an edge, no names.
    """
    if ids.count() > DEALT_IDS:
        ids = ids.hint("shuffle_hash")
    source = ids.select(F.col("id").alias("src"), F.col("n").alias("s"))
    target = ids.select(F.col("id").alias("dst"), F.col("n").alias("d"))
    return edges.select("src", "dst").join(source, "src").join(target, "dst").select(
        F.col("s").alias("src"), F.col("d").alias("dst"))
