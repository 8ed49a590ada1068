"""Connected components (edge direction ignored) by alternating large-star
and small-star contraction (Kiveris et al., "Connected Components in
MapReduce and Beyond", SoCC 2014).

Each round starts with one aggregation over the edges (both directions)
that yields, per node, the large-star minimum and the two counts of the
stop test, so the test reads |V| rows instead of re-shuffling the edges.

The ids are numbered once, in their order, and the rounds move long integers;
the names come back at the end, a row a vertex.

With many edges a vertex, one edge in FIRST_SHARE goes through the rounds first (as in Afforest, Sutton et
al., IPDPS 2018). Then every edge is read and named by the components found so far, in the join that numbers it anyway;
those inside one component say nothing new, and the rest go through the rounds in their turn.

Every round stores its node statistics and its edges as Parquet in the shared
folder and drops the round before. So both sides of the large-star join are
plain shuffles of stored tables, and a hub's edges can be split over many tasks
by the skew join. The statistics tell whether any node has too many edges to
smaller ones for one task: without, the small star is a window in the same
plan; with, its minimums are pre-aggregated and joined as stored tables too.
No neighbour list is gathered.
It stops when the edge set is a forest of stars centred at each component's
smallest id (an exact test, not a checksum).

Output: (id, component) for every vertex, component = smallest id in the
component; an isolated vertex is its own component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators.graph import numbered, numbered_edges
from keelson.session import Stored, store


def _oriented(e: DataFrame, a: str, b: str) -> DataFrame:
    """(lo, hi) with lo < hi; self-loops dropped; duplicates kept."""
    return e.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def _canonical(e: DataFrame, a: str, b: str) -> DataFrame:
    return _oriented(e, a, b).distinct()


def _neighbour_stats(e: DataFrame) -> DataFrame:
    """Per node u over its neighbours (both directions): m = min(u, N(u)),
    up = number of smaller neighbours, down = 1 if it has a larger one.
    All combinable aggregates, so a hub is pre-aggregated in every task."""
    both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
        e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    return both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"),
        F.count_if(F.col("v") < F.col("u")).alias("up"),
        F.max(F.when(F.col("v") > F.col("u"), 1).otherwise(0)).alias("down"))


def _summary(stats: DataFrame) -> tuple[bool, int, int]:
    """One pass over the per-node statistics (|V| rows): whether the edges are
    a forest of stars, how many edges there are, and the most of one node to
    smaller ones.

    A star forest: every node has at most one smaller neighbour and no node
    with a smaller neighbour has a larger one. Each component is then a star
    centred at its minimum, the fixed point of both steps."""
    open_nodes, edges, most = stats.agg(
        F.count_if((F.col("up") > 1) | ((F.col("up") >= 1) & (F.col("down") == 1))), F.sum("up"), F.max("up")).first()
    return open_nodes == 0, edges or 0, most or 0


def _large_star(e: DataFrame, stats: DataFrame) -> DataFrame:
    # connect each larger neighbour of u to m(u)
    out = e.join(stats.select("u", "m"), e.lo == stats.u).select(F.col("m").alias("a"), F.col("hi").alias("b"))
    # no distinct here: the small-star step that follows de-duplicates
    return _oriented(out, "a", "b")


def _small_star_in_one_plan(large: DataFrame) -> DataFrame:
    """m(u) = min of u's smaller neighbours; connect them and u itself to m(u). One shuffle by u, in one plan with the step before."""
    least = F.min("lo").over(Window.partitionBy("hi"))
    with_least = large.select("lo", "hi", least.alias("m"))
    ends = F.explode(F.array("lo", "hi"))
    return _canonical(with_least.select(ends.alias("a"), F.col("m").alias("b")), "a", "b")


def _small_star(large: DataFrame) -> tuple[DataFrame, list[Stored]]:
    """The same where a node has too many edges for one task: minimums are pre-aggregated, and both sides of the
    join are stored tables, so the skew join can split a hub."""
    kept = store(large, "cc_large")
    least = store(kept.df.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m")), "cc_least")
    m = least.df
    spokes = kept.df.join(m, kept.df.hi == m.u).select(F.col("lo").alias("a"), F.col("m").alias("b"))
    hubs = m.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return _canonical(spokes.unionByName(hubs), "a", "b"), [kept, least]


# A node is a hub when it has over 1/HUB_SHARE of the edges that a task would get, and over HUB_EDGES.
HUB_SHARE, HUB_EDGES = 4, 100_000


# With at least this many edges a vertex in one of FIRST_SHARE parts of the edges, that part goes first.
FIRST_SHARE, FIRST_EDGES_A_VERTEX = 8, 1


def _star_forest(current: Stored, max_rounds: int | None, rounds: int = 0) -> tuple[Stored, int]:
    """Stars (lo = centre, hi) with the components of the given edges, and the rounds made so far; the edges are dropped."""
    tasks = int(current.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        # one aggregation gives the stop test, the large-star minimums and the hubs
        stats = store(_neighbour_stats(current.df), "cc_stats")
        done, total, most = _summary(stats.df)
        if done:
            stats.drop()
            return current, rounds
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
        large, spent = _large_star(current.df, stats.df), [stats, current]
        if most > max(HUB_EDGES, total // (HUB_SHARE * tasks)):
            small, more = _small_star(large)
            spent += more
        else:
            small = _small_star_in_one_plan(large)
        current = store(small, "cc_edges")
        for old in spent:
            old.drop()
        rounds += 1


def _labelled(labels: DataFrame, forest: DataFrame) -> DataFrame:
    """(id, n, c): ``c``, a vertex's component so far, becomes the centre that the stars link it to."""
    centre = forest.select(F.col("hi").alias("c"), "lo").distinct()
    return labels.join(centre, "c", "left").select("id", "n", F.coalesce("lo", "c").alias("c"))


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(id, component) of every vertex. ``max_rounds``: fail beyond so many rounds; None: go on to the end."""
    # the rounds move numbers, given in the order of the ids, so the least number is the least id's
    ids = numbered(vertices, "cc_ids")
    labels = ids.df.select("id", "n", F.col("n").alias("c"))
    spent, rounds = [ids], 0
    first = store(_oriented(numbered_edges(edges.filter(F.pmod(F.xxhash64("src", "dst"), F.lit(FIRST_SHARE)) == 0), ids.df),
                            "src", "dst"), "cc_edges")
    many = first.df.count() >= max(1, FIRST_EDGES_A_VERTEX * ids.df.count())
    if many:
        first, rounds = _star_forest(first, max_rounds)
        found = store(_labelled(labels, first.df), "cc_labels")
        labels, spent = found.df, [*spent, found]
    first.drop()
    named = numbered_edges(edges, labels.select("id", F.col("c").alias("n")))
    # without a first part, duplicates and orientation are sorted out by the first round itself
    rest = store(_canonical(named, "src", "dst") if many else _oriented(named, "src", "dst"), "cc_edges")
    rest, _ = _star_forest(rest, max_rounds, rounds)
    found = store(_labelled(labels, rest.df), "cc_labels")
    # one row a component of several vertices: where they are few, their names are broadcast by their stored size
    several = found.df.filter(F.col("c") != F.col("n")).select("c").distinct()
    centres = store(several.join(ids.df, F.col("c") == F.col("n")).select("c", F.col("id").alias("component")), "cc_centres")
    out = store(found.df.join(centres.df, "c", "left").select(
        "id", F.coalesce(F.col("component"), F.col("id")).alias("component")), "components")
    for old in (*spent, rest, found, centres):
        old.drop()
    return out.df


def components_after_merge(labels: DataFrame, edges: DataFrame, new_vertices: DataFrame, new_edges: DataFrame) -> DataFrame:
    """(id, component) of a graph after an insert-only merge, from the components before it.

    ``labels``: (id, component) before; ``edges``: the edges before;
    ``new_vertices`` and ``new_edges``: what the merge added. New edges, and
    old ones that waited for a new vertex, are contracted to edges between
    old components and new vertices. Components are found in that small graph
    alone, and only labels that change are replaced: rounds and stored bytes
    depend on the batch. Of the old side, labels and edges are scanned once;
    the batch's ids decide by their size whether that needs a shuffle.
    Edges whose ends are not vertices join nothing, as in ``connected_components``.
    """
    labels = labels.select("id", "component")
    ids = store(new_vertices.select("id").distinct(), "cc_new_ids")
    new = store(ids.df.join(labels, "id", "left_anti"), "cc_new")
    ends = lambda e: e.select(F.explode(F.array("src", "dst")).alias("id"))
    waiting = [edges.select("src", "dst").join(new.df.withColumnRenamed("id", end), end, "left_semi") for end in ("src", "dst")]
    live = store(new_edges.select("src", "dst").unionByName(waiting[0]).unionByName(waiting[1]).distinct(), "cc_live")
    touched = store(ends(live.df).distinct(), "cc_touched")
    nodes = store(labels.join(touched.df, "id", "left_semi").unionByName(new.df.select("id", F.col("id").alias("component"))), "cc_nodes")
    side = lambda end, to: nodes.df.select(F.col("id").alias(end), F.col("component").alias(to))
    contracted = store(live.df.join(side("src", "a"), "src").join(side("dst", "b"), "dst").select(
        F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), "cc_contracted")
    found = connected_components(nodes.df.select(F.col("component").alias("id")), contracted.df)
    moved = store(found.filter(F.col("id") != F.col("component")).select(F.col("id").alias("old"), F.col("component").alias("to")), "cc_moved")
    every = labels.unionByName(new.df.select("id", F.col("id").alias("component")))
    out = store(every.join(moved.df, every.component == moved.df.old, "left").select(
        "id", F.coalesce("to", "component").alias("component")), "components")
    for table in (ids, new, live, touched, nodes, contracted, moved):
        table.drop()
    return out.df
