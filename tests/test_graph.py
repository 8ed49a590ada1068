import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import components
import keelson.operators.graph as graph_module
import keelson.operators.merge as merge_module
import keelson.operators.pagerank as pagerank_module
from keelson.operators.components import connected_components
from keelson.operators.graph import PurchaseGraph, build_vertices, merged_graph, numbered
from keelson.operators.merge import combine_output, merge_edges, merge_vertices, new_rows, split_output
from keelson.operators.pagerank import pagerank, ranked_vertices, top_k
from keelson.session import store
from tests.fixtures import COMPONENTS, NEW_CUSTOMERS, NEW_PRODUCTS, NEW_PURCHASES, RAW_RANKS, retail


def test_pagerank_values(spark):
    g = merged_graph(retail(spark))
    raw = {r.id: r.pagerank for r in pagerank(g.vertices, g.edges, normalize=False).collect()}
    norm = {r.id: r.pagerank for r in pagerank(g.vertices, g.edges).collect()}
    assert raw == pytest.approx(RAW_RANKS)
    total = sum(RAW_RANKS.values())
    assert norm == pytest.approx({v: 6 * r / total for v, r in RAW_RANKS.items()})


def test_components_and_top_k(spark):
    g = merged_graph(retail(spark))
    assert {r.id: r.component for r in connected_components(g.vertices, g.edges).collect()} == COMPONENTS
    ranked = ranked_vertices(g.vertices, pagerank(g.vertices, g.edges))
    assert [r.id for r in top_k(ranked, "customer", 2).collect()] == ["c:7", "c:8"]  # all tie; ties broken by id
    assert [r.id for r in top_k(ranked, "product", 10).collect()] == ["p:7", "p:12", "p:8"]


def test_close_ranks_are_not_ties(spark):
    ranked = spark.createDataFrame([("p:a", "product", 1.00000010), ("p:b", "product", 1.00000020)],
                                   "id string, vertex_type string, pagerank double")
    assert [r.id for r in top_k(ranked, "product", 1).collect()] == ["p:b"]


def test_duplicate_vertex_ids_are_rejected(spark):
    g = merged_graph(retail(spark))
    assert g.checked() is g
    twice = PurchaseGraph(g.vertices.unionByName(g.vertices.filter("id = 'p:8'")), g.edges)
    with pytest.raises(ValueError, match="p:8"):
        twice.checked()


def python_pagerank(nodes, edges, iters=10, reset=0.15):
    outdeg = {}
    for s, d in edges:
        outdeg[s] = outdeg.get(s, 0) + 1
    rank = {n: 1.0 for n in nodes}
    for _ in range(iters):
        msg = {n: 0.0 for n in nodes}
        for s, d in edges:
            msg[d] += rank[s] / outdeg[s]
        rank = {n: reset + (1 - reset) * msg[n] for n in nodes}
    total = sum(rank.values())
    return {n: r * len(nodes) / total for n, r in rank.items()}


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return {n: min(members) for members in groups.values() for n in members}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pagerank_matches_python_loop_on_cyclic_graphs(spark, seed):
    rnd = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(40)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(120)]
    edges = [(s, d) for s, d in edges if s != d] + [(nodes[0], nodes[1]), (nodes[0], nodes[1])]  # parallel edge
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.pagerank for r in pagerank(v, e, store_interval=3).collect()}
    want = python_pagerank(nodes, edges)
    assert got.keys() == want.keys()
    for n in nodes:
        assert got[n] == pytest.approx(want[n], rel=1e-9)


@pytest.mark.parametrize("seed", [4, 5, 6, 7])
def test_components_match_union_find(spark, seed):
    rnd = random.Random(seed)
    nodes = [f"v{i:03d}" for i in range(rnd.randint(30, 90))]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(rnd.randint(10, 80))]
    # a long chain too, the slow case for label propagation
    edges += [(nodes[i], nodes[i + 1]) for i in range(0, min(25, len(nodes) - 1))]
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    e = spark.createDataFrame(edges + [("v000", "ghost")], "src string, dst string")  # dangling edge dropped
    got = {r.id: r.component for r in connected_components(v, e).collect()}
    assert got == union_find(nodes, edges)


def test_merge_keeps_existing_and_batch_duplicates(spark):
    existing = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, name string")
    updates = spark.createDataFrame([("a", "new"), ("c", "new"), ("c", "dup"), (None, "nullid")],
                                    "id string, name string")
    got = sorted((tuple(r) for r in merge_vertices(existing, updates).collect()), key=repr)
    assert got == sorted([("a", "old"), ("b", "old"), ("c", "new"), ("c", "dup"), (None, "nullid")], key=repr)


def test_merge_is_by_name_and_idempotent(spark):
    existing = spark.createDataFrame([("a", "x", "NY")], "id string, name string, location string")
    swapped = spark.createDataFrame([("Boston", "y", "b")], "location string, name string, id string")
    merged = merge_vertices(existing, swapped)
    assert {r.id: r.location for r in merged.collect()} == {"a": "NY", "b": "Boston"}
    again = merge_vertices(merged, swapped)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_edge_merge_drops_known_pairs(spark):
    g = merged_graph(retail(spark, NEW_CUSTOMERS, NEW_PRODUCTS, NEW_PURCHASES))
    pairs = [(r.src, r.dst) for r in g.edges.collect()]
    assert len(pairs) == 7 and pairs.count(("c:10", "p:13")) == 2 and pairs.count(("c:7", "p:8")) == 1
    names = {r.id: r.name for r in g.vertices.collect()}
    assert len(names) == 8 and names["c:9"] == "Oluchi" and names["p:12"] == "Rug" and names["c:10"] == "Noor"


def test_small_batch_leaves_the_existing_side_in_place(spark, scratch):
    path = scratch("existing")
    spark.range(200000).selectExpr("concat('c:', id) AS src", "concat('p:', id % 100) AS dst",
                                   "'PURCHASED' AS relationship").write.parquet(path)
    batch = spark.createDataFrame([("c:1", "p:1", "PURCHASED"), ("c:x", "p:1", "PURCHASED")],
                                  "src string, dst string, relationship string")
    out = merge_edges(spark.read.parquet(path), batch)
    assert out.count() == 200001
    plan = new_rows(store(batch, "b").df, spark.read.parquet(path), ["src", "dst", "relationship"])
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and "hashpartitioning" not in final
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a batch over the threshold
    try:
        assert merge_edges(spark.read.parquet(path), batch).count() == 200001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_namespaced_ids_keep_overlapping_keys_apart(spark):
    c = spark.createDataFrame([(1, "x", "NY")], "customer_id int, name string, location string")
    p = spark.createDataFrame([(1, "y", "cat", 1.0)], "product_id int, name string, category string, price double")
    assert sorted(r.id for r in build_vertices(c, p).collect()) == ["c:1", "p:1"]
    assert build_vertices(c, p, namespaced=False).select("id").distinct().count() == 1


def test_combine_split_round_trip_through_parquet(spark, scratch):
    g = merged_graph(retail(spark))
    path = scratch("combined")
    combine_output(g.vertices, g.edges).write.parquet(path)
    v, e = split_output(spark.read.parquet(path))
    assert v.columns == g.vertices.columns and e.columns == g.edges.columns
    assert v.count() == 6 and e.count() == 5
    assert v.exceptAll(g.vertices).count() == 0 and e.exceptAll(g.edges).count() == 0


def test_both_directions_ranks_customers(spark):
    g = merged_graph(retail(spark))
    r = {x.id: x.pagerank for x in pagerank(g.vertices, g.edges, direction="both").collect()}
    links = [(x.src, x.dst) for x in g.edges.collect()]
    want = python_pagerank(sorted(r), links + [(d, s) for s, d in links])
    assert r == pytest.approx(want) and sum(r.values()) == pytest.approx(6.0)


def test_pagerank_with_a_hot_source_matches_python_loop(spark):
    # one hub source holds most edges: it takes the broadcast path
    rnd = random.Random(11)
    nodes = [f"h{i:03d}" for i in range(60)]
    edges = [("h000", n) for n in nodes[1:]] * 3 + [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(40)]
    edges = [(s, d) for s, d in edges if s != d]
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.pagerank for r in pagerank(v, e, partitions=4).collect()}
    want = python_pagerank(nodes, edges)
    for n in nodes:
        assert got[n] == pytest.approx(want[n], rel=1e-9)


def test_pagerank_drops_dangling_edges(spark):
    nodes = ["a", "b", "c"]
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    clean = spark.createDataFrame(edges, "src string, dst string")
    dirty = spark.createDataFrame(edges + [("a", "ghost"), ("ghost", "b"), (None, "a")], "src string, dst string")
    got = {r.id: r.pagerank for r in pagerank(v, dirty).collect()}
    want = {r.id: r.pagerank for r in pagerank(v, clean).collect()}
    assert got == pytest.approx(want) and set(got) == set(nodes)
    assert want == pytest.approx(python_pagerank(nodes, edges))


def test_new_rows_with_duplicate_existing_keys(spark):
    existing = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3)], "src string, dst string, n int")
    batch = spark.createDataFrame([("a", "b", 9), ("x", "y", 8), ("x", "y", 7), (None, "b", 6)],
                                  "src string, dst string, n int")
    got = sorted((r.n for r in new_rows(batch, existing, ["src", "dst"]).collect()))
    assert got == [6, 7, 8]


@pytest.fixture()
def skew_conf(spark):
    """No broadcasts, and thresholds at which small test data counts as skewed."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split_joins(df) -> int:
    """Joins that the final plan splits because of a skewed side."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("skew=true")


def hub_edges(spark):
    """80 % of all edges start at one vertex."""
    return spark.range(100000).selectExpr(
        "if(id < 80000, 'a', concat('b', id % 3000)) AS lo", "concat('x', id) AS hi")


def test_hub_edges_are_split_in_components(spark, skew_conf):
    e = store(hub_edges(spark), "hub").df
    stats = store(components._neighbour_stats(e), "stats").df
    assert split_joins(components._large_star(e, stats)) == 1
    hi_hub = store(e.select(F.col("lo").alias("hi"), F.concat(F.lit("0"), "hi").alias("lo")), "hub").df
    assert split_joins(components._small_star(hi_hub)[0]) >= 1


def test_hub_edges_are_split_in_pagerank_weights(spark, skew_conf):
    pairs = store(hub_edges(spark).selectExpr("lo AS src", "hi AS dst", "1L AS m"), "pairs").df
    degrees = store(pagerank_module._out_degrees(pairs), "degrees").df
    assert split_joins(pagerank_module._weighted(pairs, degrees)) == 1


def test_pagerank_stops_when_ranks_are_fixed(spark, monkeypatch):
    g = merged_graph(retail(spark))
    rounds = []
    keep = pagerank_module.store
    monkeypatch.setattr(pagerank_module, "store", lambda df, label: (rounds.append(label), keep(df, label))[1])
    got = {r.id: r.pagerank for r in pagerank(g.vertices, g.edges, normalize=False).collect()}
    assert got == pytest.approx(RAW_RANKS) and rounds.count("pr_sums") == 3  # of 10


def stored_types(monkeypatch, module) -> dict[str, dict[str, str]]:
    """Column types of each frame that the module stores from now on, by label."""
    keep, found = module.store, {}
    monkeypatch.setattr(module, "store", lambda df, label: (found.update({label: dict(df.dtypes)}), keep(df, label))[1])
    return found


def test_rounds_move_numbers_not_names(spark, monkeypatch):
    g = merged_graph(retail(spark))
    ranks, comps = stored_types(monkeypatch, pagerank_module), stored_types(monkeypatch, components)
    pagerank(g.vertices, g.edges)
    connected_components(g.vertices, g.edges)
    for label in ("pr_pairs", "pr_degrees", "pr_sums"):
        assert "string" not in ranks[label].values(), label
    assert ranks["pr_sums"].keys() == {"n", "s"}
    for label in ("cc_edges", "cc_stats"):
        assert "string" not in comps[label].values(), label


def test_components_are_named_by_the_least_id_with_null_and_repeated_ids(spark):
    v = spark.createDataFrame([(i,) for i in ["b", "a10", "a9", None, "z", "b"]], "id string")
    e = spark.createDataFrame([("b", "a9"), ("a10", "a9"), ("z", None), (None, "a9"), ("z", "ghost")], "src string, dst string")
    got = sorted(map(tuple, connected_components(v, e).collect()), key=repr)
    assert got == sorted([("b", "a10"), ("a10", "a10"), ("a9", "a10"), ("z", "z"), (None, None)], key=repr)


def test_numbers_follow_the_order_of_the_ids(spark):
    v = spark.createDataFrame([(f"k{i % 700}",) for i in range(1400)], "id string").repartition(7)
    rows = sorted((r.id, r.n) for r in numbered(v, "numbers", 5).df.collect())
    assert len(rows) == 700 and rows[0][1] >= 5
    assert all(a[1] < b[1] for a, b in zip(rows, rows[1:]))


def test_sums_that_differ_in_their_last_bits_are_the_same(spark):
    frame = lambda s: spark.createDataFrame([(1, s), (2, 5.0)], "n long, s double")
    assert pagerank_module._same_sums(frame(0.1 + 0.2), frame(0.3))
    assert not pagerank_module._same_sums(frame(0.3), frame(0.3 + 1e-11))
    assert not pagerank_module._same_sums(frame(0.3).filter("n = 2"), frame(0.3))


def test_ranks_after_a_merge_stop_when_they_are_fixed(spark, monkeypatch):
    g = merged_graph(retail(spark))
    state = pagerank_module.RankState()
    pagerank(g.vertices, g.edges, state=state)
    more = spark.createDataFrame([("c:8", "p:7"), ("c:new", "p:8")], "src string, dst string")
    new = spark.createDataFrame([("c:new",)], "id string")
    got = {r.id: r.pagerank for r in pagerank_module.pagerank_after_merge(state, g.edges, new, more).collect()}
    vertices, edges = g.vertices.select("id").unionByName(new), g.edges.select("src", "dst").unionByName(more)
    assert got == pytest.approx({r.id: r.pagerank for r in pagerank(vertices, edges).collect()}, abs=1e-12)
    assert len(state.pushed) == 3  # of 10
    state.drop()


def test_analytics_leave_only_their_results(spark, scratch):
    import os
    g = merged_graph(retail(spark)).materialized()
    root = os.path.dirname(scratch("x"))
    before = set(os.listdir(root))
    pagerank(g.vertices, g.edges).collect()
    connected_components(g.vertices, g.edges).collect()
    assert sorted(d.rsplit("-", 1)[0] for d in set(os.listdir(root)) - before) == ["components", "pr_ranks"]


def test_every_round_is_stored_so_that_no_edges_are_moved(spark, monkeypatch):
    nodes = [f"r{i:02d}" for i in range(30)]
    edges = [(nodes[i], nodes[(i * 7 + 1) % 30]) for i in range(30)] + [("r00", n) for n in nodes[5:]] + [("r01", "r00")]
    v, e = spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "src string, dst string")
    rounds, keep = [], pagerank_module.store
    monkeypatch.setattr(pagerank_module, "store", lambda df, label: (rounds.append(label), keep(df, label))[1])
    pagerank(v, e)
    assert rounds.count("pr_sums") == 10  # a plan over two rounds would bring its own partitioning to the edges


def test_few_partitions_by_source_at_any_size(spark):
    assert pagerank_module._grid(1) == (1, 1) and pagerank_module._grid(4) == (4, 1) and pagerank_module._grid(12) == (4, 3)
    for blocks in (8, 27, 1000):
        by_source, groups = pagerank_module._grid(blocks)
        assert blocks <= by_source * groups < blocks + by_source and by_source <= max(4, blocks ** 0.5)


@pytest.mark.parametrize("hub", [False, True])
def test_pagerank_in_groups_of_targets_matches_python_loop(spark, hub):
    rnd = random.Random(12)
    nodes = [f"g{i:03d}" for i in range(50)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(200)] + ([("g000", n) for n in nodes] * 6 if hub else [])
    edges = [(s, d) for s, d in edges if s != d]
    v, e = spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "src string, dst string")
    for direction in ("out", "both"):
        got = {r.id: r.pagerank for r in pagerank(v, e, partitions=14, direction=direction).collect()}
        want = python_pagerank(nodes, edges + [(d, s) for s, d in edges] * (direction == "both"))
        assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("share", [2, 8])
def test_components_of_many_edges_a_vertex(spark, monkeypatch, share):
    monkeypatch.setattr(components, "FIRST_SHARE", share)
    kept, keep = [], components.store
    monkeypatch.setattr(components, "store", lambda df, label: (kept.append((label, keep(df, label))), kept[-1][1])[1])
    rnd = random.Random(13)
    nodes = [f"d{i:03d}" for i in range(90)]
    dense = [nodes[:40], nodes[40:75]]  # two dense groups, a chain and two alone
    edges = [(a, b) for group in dense for a in group for b in rnd.sample(group, 24)]
    edges += [(nodes[i], nodes[i + 1]) for i in range(75, 87)] + [("ghost", nodes[0]), (None, nodes[41])]
    v, e = spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.component for r in connected_components(v, e).collect()}
    assert got == union_find(nodes, [(a, b) for a, b in edges if a not in (None, "ghost")])
    # the first part goes through the rounds alone; of all edges, only those between its components do
    assert [label for label, _ in kept].count("cc_labels") == 2


def test_components_count_the_rounds_of_both_parts(spark):
    nodes = [f"m{i:03d}" for i in range(30)]
    edges = [(a, b) for a in nodes for b in nodes if a < b]
    v, e = spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "src string, dst string")
    assert {r.component for r in connected_components(v, e, max_rounds=8).collect()} == {"m000"}
    with pytest.raises(RuntimeError, match="did not converge in 0 rounds"):
        connected_components(v, e, max_rounds=0)


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_many_ids_number_the_edges_without_a_sort(spark, monkeypatch):
    monkeypatch.setattr(graph_module, "DEALT_IDS", 2)
    ids = store(spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "id string, n long"), "ids").df
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "c"), ("a", "ghost"), (None, "a"), ("c", None)],
                              "src string, dst string")
    out = graph_module.numbered_edges(e, ids)
    assert sorted(map(tuple, out.collect())) == [(0, 1), (0, 1), (1, 2)]
    plan = plan_of(out)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_hub_edges_are_split_when_numbered(spark, skew_conf, monkeypatch):
    monkeypatch.setattr(graph_module, "DEALT_IDS", 0)
    e = store(hub_edges(spark).selectExpr("lo AS src", "hi AS dst"), "hub").df
    ids = numbered(e.selectExpr("explode(array(src, dst)) AS id"), "ids").df
    out = graph_module.numbered_edges(e, ids)
    assert out.count() == 100000 and split_joins(out) >= 1


def test_a_large_batch_is_merged_without_a_sort(spark, skew_conf, monkeypatch):
    monkeypatch.setattr(merge_module, "DEALT_ROWS", 1)
    existing = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), (None, "b", 4)], "src string, dst string, n int")
    batch = spark.createDataFrame([("a", "b", 9), ("x", "y", 8), ("x", "y", 7), (None, "b", 6)], "src string, dst string, n int")
    assert sorted(r.n for r in merge_edges(existing, batch, ["src", "dst"]).collect()) == [1, 2, 3, 4, 6, 7, 8]
    plan = plan_of(new_rows(batch, existing, ["src", "dst"], dealt=True))
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_a_merge_joins_lineitem_and_orders_once(spark, scratch):
    from keelson import registry
    from keelson.sources import adapters as A
    sf = scratch("sf")
    days = ["2000-09-30 00:00:00", "2000-10-01 00:00:00", "2000-12-31 23:59:59", "2001-01-01 00:00:00", None, "1995-05-05 05:05:05"]
    tables = {
        "customer": spark.createDataFrame([(i, f"n{i}", "s") for i in range(15)], "c_custkey long, c_name string, c_mktsegment string"),
        "part": spark.createDataFrame([(i, f"n{i}", "t", 1.0) for i in range(15)],
                                      "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": spark.createDataFrame([(i, i % 15 if i != 7 else None, days[i % 6]) for i in range(30)],
                                        "o_orderkey long, o_custkey long, d string").selectExpr(
            "o_orderkey", "o_custkey", "CAST(d AS TIMESTAMP_NTZ) AS o_orderdate"),
        "lineitem": spark.createDataFrame([(i % 32, (i * 7) % 15, i // 32, float(i), 2.0 * i) for i in range(90)],
                                          "l_orderkey long, l_partkey long, l_linenumber long, l_quantity double, l_extendedprice double"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{sf}/{name}.parquet")
    g = registry.graph(spark, sf)
    assert not any("lineitem" in f or "orders" in f for f in g.edges.inputFiles())
    want = merged_graph(A.retail_inputs(spark, sf))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert g.edges.columns == want.edges.columns and rows(g.edges) == rows(want.edges)
    assert rows(g.edges) and rows(g.vertices) == rows(want.vertices)
