"""Served names: one switch, and the log of what was served."""
import pytest
from pyspark.sql import functions as F

from keelson.session import unique_name
from keelson.sinks import served
from keelson.sinks import versioned as V
from keelson.sinks.served import PublishLog

V1 = [("x", "2024-01-01", 0), ("y", "2024-01-02", 5), ("n", "2024-01-02", None)]
V2 = [("x2", "2024-01-01", 0), ("z2", "2024-01-03", 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "name string, date string, hour int")


class Watched:
    """A session whose every SQL statement is followed by a read of ``name`` through the real one."""

    def __init__(self, spark, name, fail_at=None):
        self._spark, self._name, self._fail = spark, name, fail_at
        self.seen, self.statements = [], []

    def __getattr__(self, item):
        return getattr(self._spark, item)

    def sql(self, statement, *args, **kwargs):
        self.statements.append(statement)
        if self._fail is not None and self._fail in statement:
            raise RuntimeError("metastore went away")
        out = self._spark.sql(statement, *args, **kwargs)
        table = self._spark.table(self._name)
        self.seen.append((tuple(table.columns), tuple(sorted(map(str, table.collect())))))
        return out


def shown(spark, name):
    table = spark.table(name)
    return tuple(table.columns), tuple(sorted(map(str, table.collect())))


def partitioned(spark, scratch, label="served"):
    base, name = scratch(label), f"default.{unique_name('t')}"
    served.create_served(spark, name, frame(spark, []).schema, ["date", "hour"])
    V.write_version(frame(spark, V1), base, "v1", ["date", "hour"])
    V.write_version(frame(spark, V2).withColumn("extra", F.lit(7)).select("name", "extra", "date", "hour"), base, "v2", ["date", "hour"])
    return base, name


def test_a_reader_between_any_two_statements_sees_old_or_new(spark, scratch):
    base, name = partitioned(spark, scratch)
    assert spark.table(name).count() == 0
    for version in ("v1", "v2", "v1"):
        before = shown(spark, name)
        watched = Watched(spark, name)
        V.publish_partitioned(watched, name, base, version)
        after = shown(spark, name)
        assert before != after and len(watched.seen) > 3
        states = watched.seen
        switch = states.index(after)
        assert all(s == before for s in states[:switch]) and all(s == after for s in states[switch:])
        assert V.table_location(spark, name) == V.version_path(base, version)
    assert shown(spark, name)[0] == ("name", "extra", "date", "hour")  # a column that v1 lacks stays, as null
    assert {r.name: r.extra for r in spark.table(name).collect()} == {"x": None, "y": None, "n": None}
    assert sorted(r[0] for r in V.list_partitions(spark, name).collect()) == [
        "date=2024-01-01/hour=0", "date=2024-01-02/hour=5", "date=2024-01-02/hour=null"] or \
        V.list_partitions(spark, name).count() == 3


def test_an_unpartitioned_name_changes_rows_and_schema_at_once(spark, scratch):
    base, name = scratch("plain"), f"default.{unique_name('t')}"
    V.write_version(spark.createDataFrame([("a",)], "id string"), base, "v1")
    V.write_version(spark.createDataFrame([("b", 2)], "id string, n int"), base, "v2")
    V.write_version(spark.createDataFrame([(3.5,)], "id double"), base, "v3")
    V.publish_table(spark, name, base, "v1")
    for version, rows in (("v2", [("b", 2)]), ("v3", [(3.5,)]), ("v1", [("a",)])):
        before = shown(spark, name)
        watched = Watched(spark, name)
        V.publish_table(watched, name, base, version)
        after = shown(spark, name)
        assert set(watched.seen) <= {before, after} and [tuple(r) for r in spark.table(name).collect()] == rows


@pytest.mark.parametrize("step", ["CREATE TABLE", "ADD IF NOT EXISTS", "CREATE OR REPLACE VIEW"])
def test_a_failure_before_the_switch_changes_nothing(spark, scratch, step):
    base, name = partitioned(spark, scratch, "fails")
    log = PublishLog(spark, scratch("fails_log"))
    log.publish(name, base, "v1")
    before = shown(spark, name)
    log.spark = Watched(spark, name, step)
    with pytest.raises(RuntimeError, match="went away"):
        log.publish(name, base, "v2")
    assert shown(spark, name) == before
    log.spark = spark
    assert [r.version for r in log.history(name).orderBy("nth").collect()] == ["v1"]
    assert log.events().filter("kind = 'failed'").count() == 1
    log.publish(name, base, "v2")
    assert [r.version for r in log.history(name).orderBy("nth").collect()] == ["v1", "v2"]
    assert len(served.version_tables(spark, name, set())) == 2  # the one shown and the one before


def test_bad_versions_are_refused(spark, scratch):
    base, name = partitioned(spark, scratch, "bad")
    V.publish_partitioned(spark, name, base, "v1")
    with pytest.raises(ValueError, match="no version"):
        V.publish_partitioned(spark, name, base, "v9")
    V.write_version(frame(spark, V1).withColumn("name", F.lit(3)), base, "v3", ["date", "hour"])
    with pytest.raises(ValueError, match="changes the type"):
        V.publish_partitioned(spark, name, base, "v3")
    V.write_version(frame(spark, V1), base, "v4", ["date"])
    with pytest.raises(ValueError, match="isn't partitioned"):
        V.publish_partitioned(spark, name, base, "v4")
    assert spark.table(name).count() == 3
    V.drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and not served.version_tables(spark, name, set())
    assert spark.read.parquet(V.version_path(base, "v1")).count() == 3


def test_log_answers_any_time_and_rolls_back(spark, scratch):
    base, name = partitioned(spark, scratch, "log")
    log = PublishLog(spark, scratch("log"))
    for v in ("v1", "v2"):
        log.publish(name, base, v)
    log.roll_back(name)
    rows = log.history(name).orderBy("nth").collect()
    assert [(r.kind, r.version, r.partitions, r.row_count) for r in rows] == [
        ("publish", "v1", 3, 3), ("publish", "v2", 2, 2), ("rollback", "v1", 3, 3)]
    assert [r.served_until for r in rows] == [rows[1].published_at, rows[2].published_at, None]
    names = [sorted(r.name for r in log.as_of(name, x.published_at).collect()) for x in rows]
    assert names == [["n", "x", "y"], ["x2", "z2"], ["n", "x", "y"]]
    just_before = rows[1].published_at.replace() - (rows[1].published_at - rows[0].published_at) / 2
    assert sorted(r.name for r in log.as_of(name, just_before).collect()) == ["n", "x", "y"]
    with pytest.raises(ValueError, match="showed nothing"):
        log.as_of(name, rows[0].published_at - (rows[2].published_at - rows[0].published_at))
    with pytest.raises(ValueError, match="no publish"):
        log.roll_back(name, 9)
    tuples = {(r.tuple["date"], r.tuple["hour"]): r.row_count for r in log.tuples().filter(
        F.col("publish_id") == rows[1].publish_id).collect()}
    assert tuples == {("2024-01-01", "0"): 1, ("2024-01-03", "1"): 1}


def test_an_entry_whose_switch_never_came_is_taken_back(spark, scratch):
    base, name = partitioned(spark, scratch, "died")
    log = PublishLog(spark, scratch("died_log"))
    what = log.publish(name, base, "v1")
    lost = served.Serving(V.version_path(base, "v2"), base, "v2", what.table, "f" * 12, ["date", "hour"])
    log.begin(name, lost, "publish", spark.table(name).schema, ["date", "hour"])  # the process died here
    log.publish(name, base, "v1")
    assert [r.version for r in log.history(name).orderBy("nth").collect()] == ["v1", "v1"]


def test_counts_come_from_footers(spark, scratch):
    base, _ = partitioned(spark, scratch, "footers")
    df = spark.read.schema("name string, date string, hour int").parquet(V.version_path(base, "v1"))
    plan = V.partition_specs(df, ["date", "hour"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_plain_tables_keep_all_partitions_while_they_move(spark, scratch):
    base, name = scratch("moves"), f"default.{unique_name('t')}"
    df = frame(spark, [(f"n{i}", "2024-01-01", i) for i in range(6)])
    V.create_partitioned_table(spark, name, df.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(df, base, "v1", ["date", "hour"])
    V.write_version(df.withColumn("name", F.concat("name", F.lit("b"))), base, "v2", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    watched = Watched(spark, name)
    V.publish_partitioned(watched, name, base, "v2")
    assert all(len(rows) == 6 for _, rows in watched.seen)
    # partitions that were published from several roots go back to where each was
    spark.sql(f"ALTER TABLE {name} PARTITION (date = '2024-01-01', hour = 3) SET LOCATION '{base}/v1/date=2024-01-01/hour=3'")
    mixed = shown(spark, name)
    with pytest.raises(RuntimeError, match="went away"):
        V.publish_partitioned(Watched(spark, name, "REFRESH TABLE"), name, base, "v1")
    spark.sql(f"REFRESH TABLE {name}")
    assert shown(spark, name) == mixed
