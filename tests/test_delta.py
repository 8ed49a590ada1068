"""Delta versions, incremental components, digests, quarantine."""
import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import components
from keelson.operators.compare import bucket_digests, compare_by_digest, compare_frames
from keelson.operators.components import components_after_merge, connected_components
from keelson.operators.merge import insert_only_merge
from keelson.session import shared_dir, unique_name
from keelson.sinks.delta import DeltaVersions
from keelson.sources.quarantine import read_csv_checked, read_json_checked, write_quarantine

KEYS = ["src", "dst"]


def edges(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, n int")


def rows_of(df):
    return sorted(map(str, df.select("src", "dst", "n").collect()))


def size_of(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


OLD = [(f"s{i % 50}", f"d{i}", i) for i in range(4000)]
BATCH = [("s1", "d1", -1), ("s1", "new", 1), ("s1", "new", 2), (None, "d1", 3), ("s9", "d77", 4)]


@pytest.mark.parametrize("buckets", [0, 4])
def test_merges_equal_the_plain_merge(spark, scratch, buckets):
    d = DeltaVersions(spark, scratch("delta"), KEYS, buckets)
    old, batch = edges(spark, OLD), edges(spark, BATCH)
    d.create(old, "v1")
    assert d.merge("v1", "v2", batch) == 4
    want = insert_only_merge(old, batch, KEYS)
    assert rows_of(d.read("v2")) == rows_of(want)
    assert rows_of(d.read("v1")) == rows_of(old)  # the version before stays as it was
    assert d.merge("v2", "v3", batch) == 1  # a null key is never known
    assert [s.rows for s in d.segments("v3")] == [4000, 4, 1]
    d.compact("v3", "v4")
    assert len(d.segments("v4")) == 1 and rows_of(d.read("v4")) == rows_of(d.read("v3"))
    assert size_of(spark, f"{d.base}/v2") < size_of(spark, f"{d.base}/v1") / 2
    for v in ("v1", "v2", "v3", "v4"):
        d.forget(v)


def test_written_bytes_follow_the_batch(spark, scratch):
    d = DeltaVersions(spark, scratch("bytes"), ["id"])
    wide = lambda a, b: spark.range(a, b).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    d.create(wide(0, 200_000), "v1")
    sizes = []
    for v, n in (("small", 1000), ("large", 10_000)):
        d.merge("v1", v, wide(200_000 - n, 200_000 + n))
        sizes.append(size_of(spark, f"{d.base}/{v}/data"))
    assert sizes[0] < size_of(spark, f"{d.base}/v1") / 50
    assert 4 < sizes[1] / sizes[0] < 14


def test_large_batches_leave_the_bucketed_side_where_it_lies(spark, scratch):
    d = DeltaVersions(spark, scratch("colocated"), KEYS, 4)
    d.create(edges(spark, OLD), "v1")
    d.merge("v1", "v2", edges(spark, BATCH))
    table = unique_name("default.colocated")
    d.register("v2", table)
    from keelson.operators.merge import new_rows
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new_rows(edges(spark, BATCH), spark.table(table), KEYS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.split("\n")
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and table.split(".")[1] in x)
    depth = lines[scan].index("FileScan")
    above = []  # the operators on the way from the scan to the top
    for x in reversed(lines[:scan]):
        at = len(x) - len(x.lstrip(" :+-*"))
        if at < depth:
            above.append(x.strip(" :+-"))
            depth = at
    joined = next(i for i, x in enumerate(above) if "SortMergeJoin" in x or "ShuffledHashJoin" in x)
    assert not any("Exchange" in x for x in above[:joined]), above
    assert "Bucketed: true" in plan
    spark.sql(f"DROP TABLE {table}")


def test_delta_columns_and_errors(spark, scratch):
    d = DeltaVersions(spark, scratch("cols"), ["id"])
    d.create(spark.createDataFrame([(1, "a")], "id int, x string"), "v1")
    d.merge("v1", "v2", spark.createDataFrame([(7, 2)], "y int, id int"))
    assert sorted(tuple(r) for r in d.read("v2").collect()) == [(1, "a", None), (2, None, 7)]
    with pytest.raises(ValueError, match="no version"):
        d.read("v9")
    with pytest.raises(ValueError, match="itself"):
        d.merge("v1", "v1", spark.createDataFrame([(3, "c")], "id int, x string"))
    d.merge("v2", "v3", spark.createDataFrame([(3, 5)], "id int, x int"))
    with pytest.raises(ValueError, match="differ in the type"):
        d.read("v3")
    with pytest.raises(ValueError, match="buckets"):
        DeltaVersions(spark, d.base, ["id"], 3).read("v1")
    d.forget("v2")


def test_delta_versions_are_served(spark, scratch):
    d, name = DeltaVersions(spark, scratch("shown"), ["id"], 2), f"default.{unique_name('t')}"
    d.create(spark.range(5).toDF("id"), "v1")
    d.merge("v1", "v2", spark.range(3, 9).toDF("id"))
    for v, n in (("v1", 5), ("v2", 9), ("v1", 5)):
        d.publish(name, v)
        assert sorted(r.id for r in spark.table(name).collect()) == list(range(n))


def graph(seed, n, m):
    rnd = random.Random(seed)
    v = [f"v{i:03d}" for i in range(n)]
    e = [(rnd.choice(v), rnd.choice(v)) for _ in range(m)]
    return v, e


@pytest.mark.parametrize("seed", range(2))
def test_components_after_merge_equal_the_full_run(spark, seed):
    v, e = graph(seed, 60, 45)
    rnd = random.Random(seed)
    old_v, new_v = v[:45], rnd.sample(v[:45], 5) + v[45:]  # known ones again, and new ones
    old_e, new_e = e[:25], e[25:] + [(v[0], "ghost"), (v[0], v[0])]  # some old edges wait for new vertices
    frame = lambda x: spark.createDataFrame([(i,) for i in x], "id string")
    links = lambda x: spark.createDataFrame(x, "src string, dst string")
    labels = connected_components(frame(old_v), links(old_e))
    got = components_after_merge(labels, links(old_e), frame(new_v), links(new_e))
    want = connected_components(frame(v), links(e))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_only_the_batch_is_contracted(spark, monkeypatch):
    """A batch of three edges gives a graph of its ends' components, however large the old one is."""
    n = 3000
    old = spark.range(n).select(F.format_string("a%05d", "id").alias("id"))
    chain = spark.range(n - 1).select(F.format_string("a%05d", "id").alias("src"), F.format_string("a%05d", F.col("id") + 1).alias("dst"))
    chain = chain.filter(F.substring("src", -2, 2) != "99")  # thirty components
    labels = connected_components(old, chain)
    sizes = []
    run = components.connected_components
    monkeypatch.setattr(components, "connected_components", lambda v, e: sizes.append((v.count(), e.count())) or run(v, e))
    batch = spark.createDataFrame([("a00050", "a00150"), ("a00060", "a00170"), ("b1", "a02999")], "src string, dst string")
    got = components_after_merge(labels, chain, spark.createDataFrame([("b1",)], "id string"), batch)
    assert sizes[0][0] <= 6 and sizes[0][1] <= 3
    assert got.select("component").distinct().count() == 29
    assert {r.id: r.component for r in got.filter("id IN ('a00199', 'b1')").collect()} == {"a00199": "a00000", "b1": "a02900"}


def test_components_of_a_hub_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB_EDGES", 5)
    v, e = graph(7, 80, 120)
    e += [(x, "v000") for x in v[1:40]]
    frame, links = spark.createDataFrame([(i,) for i in v], "id string"), spark.createDataFrame(e, "src string, dst string")
    hub = sorted(map(tuple, connected_components(frame, links).collect()))
    monkeypatch.setattr(components, "HUB_EDGES", 10**9)
    monkeypatch.setattr(components, "HUB_SHARE", 10**9)
    assert hub == sorted(map(tuple, connected_components(frame, links).collect()))
    assert {tuple(r) for r in connected_components(frame, links.limit(0)).collect()} == {(x, x) for x in v}


def test_digests_find_what_row_by_row_comparison_finds(spark):
    base = spark.range(500).select("id", F.col("id").cast("string").alias("s"), F.when(F.col("id") % 7 == 0, None).otherwise(1.5).alias("x"))
    cases = [base, base.unionByName(base.limit(3)), base.filter("id <> 77"), base.withColumn("s", F.when(F.col("id") == 5, "five").otherwise(F.col("s"))),
             base.limit(0), base.withColumn("x", F.col("x") * 0)]
    for other in cases:
        assert compare_by_digest(base, other).first() == compare_frames(base, other).first()
        assert compare_by_digest(other, base, buckets=7).first() == compare_frames(other, base).first()
    assert compare_by_digest(base, base.drop("x")).first() == compare_frames(base, base.drop("x")).first()
    zeros = spark.createDataFrame([(0.0,), (float("nan"),)], "x double")
    signed = spark.createDataFrame([(-0.0,), (float("nan"),)], "x double")
    assert compare_by_digest(zeros, signed).first() == compare_frames(zeros, signed).first()
    assert bucket_digests(base, 16).count() <= 16


def test_equal_frames_shuffle_digests_only(spark, scratch):
    path = scratch("frame")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    plan = bucket_digests(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange") == 1
    row = compare_by_digest(df, df).first()
    assert tuple(row) == (True, 20_000, 20_000, 0, 0)


def test_bad_csv_records_are_kept_apart(spark, scratch):
    path, beside = scratch("csv"), scratch("quarantine")
    lines = ["id,n,day,name", "1,2,2024-01-05,ann", "2,,2024-01-06,", "x,3,2024-01-07,bob", "4,many,2024-01-07,cy", "5,6", "7,8,someday,dee", "9,1,2024-02-01,eve,more"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    found = read_csv_checked(spark, path, "id int, n int, day date, name string")
    assert sorted((r.id, r.n, str(r.day), r.name) for r in found.good.collect()) == [(1, 2, "2024-01-05", "ann"), (2, None, "2024-01-06", None)] \
        or sorted((r.id, r.n, str(r.day)) for r in found.good.collect()) == [(1, 2, "2024-01-05"), (2, None, "2024-01-06")]
    reasons = {r.record.split(",")[0]: r.reason for r in found.bad.collect()}
    assert reasons["x"] == "id is not int: x" and reasons["4"] == "n is not int: many" and reasons["7"] == "day is not date: someday"
    assert reasons["5"] == reasons["9"] == "the line doesn't have the declared fields"
    assert found.good.count() + found.bad.count() == len(lines) - 1
    assert all(r.source_file.startswith("file:") and r.source_file.endswith(".txt") for r in found.bad.collect())
    write_quarantine(found, beside)
    assert spark.read.parquet(beside).filter("seen_at IS NOT NULL").count() == 5
    found.drop()


def test_bad_json_records_are_kept_apart(spark, scratch):
    path = scratch("json")
    lines = ['{"id": 1, "n": 2.5}', '{"id": "two"}', "{broken", "", '{"n": 1}', '{"id": 3, "n": "x"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    found = read_json_checked(spark, path, "id int, n double")
    assert sorted(((r.id, r.n) for r in found.good.collect()), key=str) == [(1, 2.5), (None, 1.0)]
    assert {r.record: r.reason for r in found.bad.collect()} == {
        '{"id": "two"}': "id is not int: two", "{broken": "the line doesn't have the declared fields", '{"id": 3, "n": "x"}': "n is not double: x"}
    found.drop()


def test_merges_leave_only_what_they_return(spark):
    def folders():
        p = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark) + "/scratch")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        return {str(x.getPath().getName()) for x in fs.listStatus(p)} if fs.exists(p) else set()
    old, batch = edges(spark, OLD), edges(spark, BATCH)
    before = folders()
    assert insert_only_merge(old, batch, KEYS).count() == 4004
    assert {x.rsplit("-", 1)[0] for x in folders() - before} == {"new_rows"}


def test_states_are_made_once_a_segment(spark, scratch):
    from keelson.operators.quality import vehicle_metrics, vehicle_metrics_of, vehicle_states

    rows = [(i, None if i % 5 == 0 else f"v{i}", f"m{i % 3}", "4" if i % 2 else "0", f"2024-01-{1 + i % 9:02d}") for i in range(90)]
    events = spark.createDataFrame(rows, "id int, vin string, manufacturer string, gearPosition string, date string")
    d = DeltaVersions(spark, scratch("states"), ["id"])
    read = []

    def make(df):
        read.append({f.rsplit("/", 3)[-3] for f in df.inputFiles()})
        return vehicle_states(df, ["id", "vin"], by=["date"])

    d.create(events.filter("id < 60"), "v1")
    d.states("v1", "x", make)
    d.merge("v1", "v2", events.filter("id >= 50"))  # ten known ones again
    got = vehicle_metrics_of(d.states("v2", "x", make), ["id", "vin"])
    assert read == [{"v1"}, {"v2"}]
    d.states("v2", "x", make)
    assert len(read) == 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, vehicle_metrics(events, ["id", "vin"]).collect()), key=str)


@pytest.mark.parametrize("direction, seed", [("out", 0), ("both", 2)])
def test_ranks_after_merges_equal_the_full_run(spark, direction, seed):
    from keelson.operators.pagerank import RankState, pagerank, pagerank_after_merge

    v, e = graph(seed, 40, 160)
    e += [("v001", "ghost"), ("v002", "v002")]
    frame = lambda x: spark.createDataFrame([(i,) for i in x], "id string")
    links = lambda x: spark.createDataFrame(x, "src string, dst string")
    state = RankState()
    pagerank(frame(v[:30]), links(e[:100]), 5, direction=direction, state=state)
    steps = [(30, 36, 100, 130), (36, 40, 130, len(e))]  # two merges in a row; some old edges wait for new vertices
    for v0, v1, e0, e1 in steps:
        got = pagerank_after_merge(state, links(e[:e0]), frame(v[v0 - 3 : v1]), links(e[e0:e1]))
        want = {r.id: r.pagerank for r in pagerank(frame(v[:v1]), links(e[:e1]), 5, direction=direction).collect()}
        assert {r.id: r.pagerank for r in got.collect()} == pytest.approx(want, abs=1e-12)
    state.drop()


def test_only_changes_are_pushed(spark):
    """A batch at one end of many separate rings reaches one ring only."""
    from keelson.operators.pagerank import RankState, pagerank, pagerank_after_merge

    rings, n = 60, 5
    v = [f"r{r:02d}n{k}" for r in range(rings) for k in range(n)]
    e = [(f"r{r:02d}n{k}", f"r{r:02d}n{(k + 1) % n}") for r in range(rings) for k in range(n)] + [(f"r{r:02d}n0", f"r{r:02d}n2") for r in range(rings)]
    frame, links = spark.createDataFrame([(i,) for i in v], "id string"), spark.createDataFrame(e, "src string, dst string")
    state = RankState()
    pagerank(frame, links, 5, state=state)
    batch = spark.createDataFrame([("r07n1", "r07n4")], "src string, dst string")
    got = {r.id: r.pagerank for r in pagerank_after_merge(state, links, frame.limit(0), batch).collect()}
    want = {r.id: r.pagerank for r in pagerank(frame, links.unionByName(batch), 5).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    assert len(state.pushed) == 5 and max(state.pushed) <= n + 2
    state.drop()
