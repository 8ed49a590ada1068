"""Static PageRank as DataFrame iterations.

Semantics (fixed-iteration PageRank as in GraphX/GraphFrames): every vertex
starts at 1.0; each round ``rank(v) = reset + (1 - reset) * sum(rank(u) *
m(u,v) / outdeg(u))`` over in-edges, parallel edges counted with their
multiplicity ``m``; after the last round ranks are scaled to sum to |V|
(``normalize=True``). Edges whose ends are not vertices are dropped.

Plan: the ids are numbered once, and all later steps move long integers; the
names come back with the ranks. Parallel edges are collapsed into weights once. The weighted
edges are persisted as a grid: groups of targets, each hash-partitioned and sorted by ``src`` into the same
few partitions, so that a target's messages meet before they are moved (no more of them than
partitions), and a task keeps the sums of one group of targets only. A round is one
join of each group with the previous round's per-vertex sums (|V| rows, the only side
that is shuffled, once for all groups, or broadcast when AQE measures it small) and one
partial-aggregated shuffle on ``dst``. Each round's sums are stored in the shared folder
and the round before is dropped: a plan that still held the round before would bring its own
partitioning to the join, and Spark would move the edges to it.
When two early rounds in a row have equal sums but for the last bits,
which hang on the order in which parts of a sum arrive, all later rounds
have them too, and the loop stops.

The pairs and degrees are stored tables. Those of hot sources are joined by two plain
shuffles, where the skew join can split a hub's edges; the others are dealt alike and joined where they stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators.graph import numbered, numbered_edges
from keelson.session import Stored, store

# Defaults of the reference job.
DEFAULT_ITERATIONS = 10
DEFAULT_RESET = 0.15


def _check_direction(direction: str) -> None:
    if direction not in ("out", "both"):
        raise ValueError(f"direction must be 'out' or 'both', not {direction!r}")


def _pairs(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct numbered (src, dst) with multiplicity ``m``, both ends in ``ids``."""
    return numbered_edges(edges, ids).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))


def _ways(pairs: DataFrame, direction: str) -> DataFrame:
    """The pairs that ranks go along. With "both", a pair may stand twice: what is made of them adds up."""
    pairs = pairs.select("src", "dst", "m")
    if direction == "out":
        return pairs
    return pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "m"))


def _out_degrees(pairs: DataFrame) -> DataFrame:
    """(src, deg = edges counted with multiplicity, fanout = pairs)."""
    return pairs.groupBy("src").agg(F.sum("m").alias("deg"), F.count(F.lit(1)).alias("fanout"))


def _weighted(pairs: DataFrame, degrees: DataFrame) -> DataFrame:
    """(src, dst, weight = multiplicity / outdeg(src))."""
    return pairs.join(degrees, "src").select("src", "dst", (F.col("m") / F.col("deg")).alias("weight"))


def _persisted(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# Persisted edge blocks hold about ROWS_PER_PARTITION weighted pairs of
# numbers (some 200 MB, read as a stream), however many that takes. With little data,
# enough blocks to use the cores, but none under MIN_ROWS_PER_PARTITION.
ROWS_PER_PARTITION = 16_000_000
MIN_ROWS_PER_PARTITION = 50_000


def _partition_count(spark, total_pairs: int) -> int:
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_size = -(-total_pairs // ROWS_PER_PARTITION)
    by_cores = min(spark.sparkContext.defaultParallelism, -(-total_pairs // MIN_ROWS_PER_PARTITION))
    return max(1, by_size, min(cap, by_cores))


# A target's messages come from as many partitions of sources, so few of these; each group of targets reads all sums.
FEW_SOURCE_PARTITIONS = 4


def _grid(blocks: int) -> tuple[int, int]:
    """(partitions by source, groups of targets) whose product is about ``blocks``: FEW_SOURCE_PARTITIONS, then a square."""
    by_source = max(min(blocks, FEW_SOURCE_PARTITIONS), math.isqrt(blocks))
    return by_source, -(-blocks // by_source)


# Rounds after which two equal rounds in a row are looked for.
EARLY_ROUNDS = 4


# Sums that differ by no more than this share are the same: a sum's last bits depend on the order in which its parts
# arrive. As every sum adds up ranks with fixed weights, no later round then moves a rank by more than this share.
SAME_WITHIN = 1e-13


def _same_sums(a: DataFrame, b: DataFrame, least: float = 0.0) -> bool:
    """Whether two rounds have the same sums up to their last bits; ``least``: the size that counts for smaller ones."""
    other = b.select("n", F.col("s").alias("t"))
    s, t = F.coalesce("s", F.lit(0.0)), F.coalesce("t", F.lit(0.0))
    bound = F.lit(SAME_WITHIN) * F.greatest(F.abs(s), F.abs(t), F.lit(least))
    return a.select("n", "s").join(other, "n", "full").filter(F.abs(s - t) > bound).isEmpty()


# A source is "hot" when its fan-out exceeds total_pairs / (HOT_SHARE * partitions). At most the HOT_SOURCES hottest
# are treated so, which bounds what is broadcast at any size; the others are left to the skew join.
HOT_SHARE, HOT_SOURCES = 4, 10_000


def pagerank(vertices: DataFrame, edges: DataFrame, max_iter: int = DEFAULT_ITERATIONS,
             reset_prob: float = DEFAULT_RESET, normalize: bool = True, direction: str = "out",
             store_interval: int = 1, partitions: int | None = None, state: "RankState | None" = None) -> DataFrame:
    """(id, pagerank) for every vertex id (one row per distinct id).

    ``partitions``: blocks of the persisted edges (see ``_grid``); by default
    derived from the number of weighted pairs (see ``_partition_count``).
    ``store_interval``: rounds between stored sums; over 1, the edges are moved in the rounds between.
    ``state``: is given each round's sums, the pairs and the degrees, stored,
    for ``pagerank_after_merge``.

    Only the per-vertex message sums ``s`` (|V| rows) move between rounds:
    round i joins the persisted edges with round i-1's sums on ``src`` (the
    source's rank is ``reset + d * s``, or 1.0 in round 1) and sums
    ``weight * rank`` per ``dst``. A vertex with no in-edges has no ``s`` row.

    Edges of ordinary sources are persisted by groups of targets, hash-partitioned and sorted by
    ``src``, so no round re-shuffles or re-sorts them. Edges of hot sources
    (a source with a large share of all edges would otherwise load one task
    with that share every round) are persisted spread over (src, dst), and
    joined with a broadcast of just the hot sources' sums, ``HOT_SOURCES`` rows
    at most.
    """
    _check_direction(direction)
    spark = vertices.sparkSession
    ids = numbered(vertices, "pr_ids")
    pairs = store(_pairs(edges, ids.df), "pr_pairs")
    ways = _ways(pairs.df, direction)
    degrees = store(_out_degrees(ways), "pr_degrees")
    total_pairs = int(degrees.df.agg(F.sum("fanout")).first()[0] or 0)
    n, groups = _grid(partitions or _partition_count(spark, total_pairs))
    # hot: fan-out above total_pairs / (HOT_SHARE * n)
    hot = _persisted(degrees.df.filter(F.col("fanout") * F.lit(HOT_SHARE * n) > F.lit(total_pairs))
                     .orderBy(F.col("fanout").desc(), "src").limit(HOT_SOURCES).select("src"))
    has_hot = hot.count() > 0
    cold = ways.join(F.broadcast(hot), "src", "left_anti") if has_hot else ways
    # pairs and degrees are dealt alike, so each pair is moved once, to where it stays
    dealt = _persisted(degrees.df.select("src", "deg").repartition(n, "src").sortWithinPartitions("src"))
    group = F.pmod(F.xxhash64("dst"), F.lit(groups))
    cold_w = [_persisted(_weighted(cold.filter(group == g).repartition(n, "src"), dealt).sortWithinPartitions("src"))
              for g in range(groups)]
    hot_w = None
    if has_hot:
        hot_w = _persisted(_weighted(ways.join(F.broadcast(hot), "src", "left_semi"), degrees.df)
                           .repartition(n * groups, "src", "dst"))
    damping = 1.0 - reset_prob

    def rank_of(s):
        return F.lit(reset_prob) + F.lit(damping) * F.coalesce(s, F.lit(0.0))

    sums: DataFrame | None = None
    stored: Stored | None = None
    for i in range(max_iter):
        parts = []
        for w in [*cold_w, *([] if hot_w is None else [hot_w])]:
            if sums is None:
                parts.append(w.select("dst", "weight", F.lit(1.0).alias("rank")))
                continue
            side = sums.withColumnRenamed("n", "src")
            if w is hot_w:
                side = F.broadcast(side.join(F.broadcast(hot), "src", "left_semi"))
            parts.append(w.join(side, "src", "left").select("dst", "weight", rank_of(F.col("s")).alias("rank")))
        src_rank = reduce(DataFrame.unionByName, parts)
        sums = src_rank.groupBy(F.col("dst").alias("n")).agg(
            F.sum(F.col("weight") * F.col("rank")).alias("s"))
        # two early rounds in a row tell whether the ranks are fixed already
        if state is not None or i < EARLY_ROUNDS or i == max_iter - 1 or (i + 1) % store_interval == 0:
            before, stored = stored, store(sums, "pr_sums")
            sums = stored.df
            fixed = before is not None and i < EARLY_ROUNDS and _same_sums(before.df, sums)
            if state is not None:
                state.rounds.append([stored])
            elif before is not None:
                before.drop()
            if fixed:
                break
    ranks = ids.df.select("id", F.lit(1.0).alias("rank")) if sums is None else \
        ids.df.join(sums, "n", "left").select("id", rank_of(F.col("s")).alias("rank"))
    ranks = store(ranks, "pr_ranks").df
    for frame in (*cold_w, dealt, hot_w, hot):
        if frame is not None:
            frame.unpersist()
    if state is not None:
        state.ids, state.pairs, state.degrees = [ids], [pairs], [degrees]
        state.max_iter, state.reset_prob, state.direction = max_iter, reset_prob, direction
    else:
        for table in (ids, pairs, degrees, stored):
            if table is not None:
                table.drop()
    return _named(ranks, normalize)


def _named(ranks: DataFrame, normalize: bool) -> DataFrame:
    if normalize:
        factor = ranks.select((F.count(F.lit(1)) / F.sum("rank")).alias("f")).scalar()
        ranks = ranks.select("id", (F.col("rank") * factor).alias("rank"))
    return ranks.withColumnRenamed("rank", "pagerank")


@dataclass
class RankState:
    """What a full run leaves for merges to come: stored segments that add up.

    ``ids`` (id, n): each vertex and its number, which all else names it by;
    ``pairs`` (src, dst, m), as the edges go; ``degrees`` (src, deg), in the run's direction;
    ``rounds[i]``: (n, s), the in-sums of round i + 1; rounds after the last one are as it is.
    ``pushed``: pairs whose share changed, by round, in the last merge.
    """

    ids: list[Stored] = field(default_factory=list)
    pairs: list[Stored] = field(default_factory=list)
    degrees: list[Stored] = field(default_factory=list)
    rounds: list[list[Stored]] = field(default_factory=list)
    max_iter: int = DEFAULT_ITERATIONS
    reset_prob: float = DEFAULT_RESET
    direction: str = "out"
    pushed: list[int] = field(default_factory=list)

    def drop(self) -> None:
        for table in [*self.ids, *self.pairs, *self.degrees, *(t for r in self.rounds for t in r)]:
            table.drop()


# A change of a rank below this isn't pushed on: over ten rounds such changes stay far below 1e-12.
LEAST_CHANGE = 1e-16


def _added(segments: list[Stored], columns: list[str]) -> DataFrame:
    out = segments[0].df.select(*columns)
    for t in segments[1:]:
        out = out.unionByName(t.df.select(*columns))
    return out


def pagerank_after_merge(state: RankState, edges: DataFrame, new_vertices: DataFrame, new_edges: DataFrame,
                         normalize: bool = True) -> DataFrame:
    """(id, pagerank) of the graph after an insert-only merge, from the rounds of the run before it.

    ``edges``: the edges before; ``new_vertices``, ``new_edges``: what the
    merge added. Round by round, with the same fixed number of rounds, only
    changes go outward: from sources whose out-edges changed, and from those whose
    rank differs from the old run's of that round. What a source gives to a
    target is replaced, new share less old share; targets that no change
    reaches keep their sums. A round scans the pairs without moving them, as long
    as the changed sources are few enough to broadcast by their stored size.
    The result equals the full run up to rounding (1e-12), and ``state`` is
    brought up to date by stored changes. Old edges that waited for a new vertex count
    from now on.
    """
    d, reset = 1.0 - state.reset_prob, state.reset_prob
    known = _added(state.ids, ["id", "n"])
    given = store(new_vertices.select("id").distinct(), "pr_given")
    last = known.agg(F.max("n")).first()[0]
    fresh = numbered(given.df.join(known, "id", "left_anti"), "pr_fresh", 0 if last is None else last + 1)
    mark = lambda end: fresh.df.select(F.col("id").alias(end), F.lit(True).alias(f"new_{end}"))
    waiting = edges.select("src", "dst").join(mark("src"), "src", "left").join(mark("dst"), "dst", "left").filter(
        F.col("new_src").isNotNull() | F.col("new_dst").isNotNull()).select("src", "dst")
    ends = store(new_edges.select("src", "dst").unionByName(waiting), "pr_ends")
    touched = ends.df.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    there = store(known.unionByName(fresh.df).join(touched, "id", "left_semi"), "pr_there")
    added = store(_pairs(ends.df, there.df), "pr_pairs")
    new_pairs = _ways(added.df, state.direction)
    more = store(new_pairs.groupBy("src").agg(F.sum("m").alias("deg")), "pr_degrees")
    spent = [given, ends, there]

    # sources whose out-edges changed, with both degrees; they push in every round
    old_deg = _added(state.degrees, ["src", "deg"])
    changed = store(more.df.select("src", F.col("deg").alias("plus")).join(
        old_deg.groupBy("src").agg(F.sum("deg").alias("deg")), "src", "left").select(
        "src", F.coalesce("deg", F.lit(0)).alias("deg"), "plus"), "pr_changed")
    spent.append(changed)
    state.pushed = []
    delta: Stored | None = None
    rounds = list(state.rounds)
    old_pairs = _ways(_added(state.pairs, ["src", "dst", "m"]), state.direction)
    is_new = fresh.df.select(F.col("n").alias("src"), F.lit(True).alias("fresh"))
    for i in range(state.max_iter):
        movers = changed.df.select("src") if delta is None else changed.df.select("src").unionByName(
            delta.df.filter(F.abs("s") > LEAST_CHANGE).select(F.col("n").alias("src"))).distinct()
        movers = store(movers, "pr_movers")
        sources = movers.df.join(changed.df.select("src", "plus"), "src", "left").join(is_new, "src", "left")
        deg = old_deg.join(movers.df, "src", "left_semi").groupBy("src").agg(F.sum("deg").alias("deg"))
        sources = sources.join(deg, "src", "left")
        if i == 0:
            sources = sources.withColumns({"old": F.when(F.col("fresh"), 0.0).otherwise(1.0), "new": F.lit(1.0)})
        else:
            old = rounds[min(i, len(rounds)) - 1]
            sums = _added(old, ["n", "s"]).withColumnRenamed("n", "src").join(movers.df, "src", "left_semi").groupBy("src").agg(
                F.sum("s").alias("s"))
            plus = delta.df.select(F.col("n").alias("src"), F.col("s").alias("ds"))
            sources = sources.join(sums, "src", "left").join(plus, "src", "left").withColumns({
                "old": F.when(F.col("fresh"), 0.0).otherwise(reset + d * F.coalesce("s", F.lit(0.0))),
                "new": reset + d * (F.coalesce("s", F.lit(0.0)) + F.coalesce("ds", F.lit(0.0)))})
        total = F.coalesce("deg", F.lit(0)) + F.coalesce("plus", F.lit(0))
        shares = store(sources.select("src", F.try_divide("new", total).alias("new_share"),
                                      F.coalesce(F.try_divide("old", F.col("deg")), F.lit(0.0)).alias("old_share")), "pr_shares")
        moved = old_pairs.join(shares.df, "src").select("dst", (F.col("m") * (F.col("new_share") - F.col("old_share"))).alias("x")).unionByName(
            new_pairs.join(shares.df, "src").select("dst", (F.col("m") * F.col("new_share")).alias("x")))
        following = store(moved.groupBy(F.col("dst").alias("n")).agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("moved")), "pr_delta")
        state.pushed.append(int(following.df.agg(F.sum("moved")).first()[0] or 0))
        for table in (movers, shares):
            table.drop()
        before, delta = delta, following
        if i < len(rounds):
            state.rounds[i] = rounds[i] + [delta]
        else:  # the old run had ended early: its last round holds for this one too
            state.rounds.append(rounds[-1] + [delta] if rounds else [delta])
        # neither the old run's rounds nor what they are changed by move any more: nor would later rounds
        if len(rounds) < state.max_iter and i >= max(1, len(rounds) - 1) and _same_sums(before.df, delta.df, reset):
            break
    state.ids.append(fresh)
    state.pairs.append(added)
    state.degrees.append(more)
    for table in spent:
        table.drop()
    ids = _added(state.ids, ["id", "n"])
    if not state.rounds or not state.max_iter:
        return _named(ids.select("id", F.lit(1.0).alias("rank")), normalize)
    sums = _added(state.rounds[-1], ["n", "s"]).groupBy("n").agg(F.sum("s").alias("s"))
    ranks = store(ids.join(sums, "n", "left").select("id", (reset + d * F.coalesce("s", F.lit(0.0))).alias("rank")), "pr_ranks")
    return _named(ranks.df, normalize)


def ranked_vertices(vertices: DataFrame, ranks: DataFrame) -> DataFrame:
    """(id, vertex_type, pagerank): ranks joined back to the vertex type."""
    return vertices.select("id", "vertex_type").join(ranks, "id")


def top_k(ranked: DataFrame, vertex_type: str, k: int) -> DataFrame:
    """Top ``k`` vertices of one type by rank; ties broken by id (a
    TakeOrderedAndProject: each task keeps only k rows). Ranks are compared
    to 12 decimals: sums of floats differ in the last bits from run to run."""
    return (ranked.filter(F.col("vertex_type") == vertex_type)
            .orderBy(F.round("pagerank", 12).desc(), F.col("id").asc())
            .limit(k))
