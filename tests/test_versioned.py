import pytest
from pyspark.sql import functions as F

from keelson.session import unique_name
from keelson.sinks import versioned as V


def frame(spark, rows):
    return spark.createDataFrame(rows, "name string, date string, hour int")


def test_publish_repoints_drops_stale_and_rolls_back(spark, scratch):
    base = scratch("pub")
    name = f"default.{unique_name('t')}"
    v1 = frame(spark, [("x", "2024-01-01", 0), ("y", "2024-01-02", 5)])
    v2 = frame(spark, [("x2", "2024-01-01", 0)])
    V.create_partitioned_table(spark, name, v1.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(v1, base, "v1", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    assert sorted(r.name for r in spark.table(name).collect()) == ["x", "y"]
    V.write_version(v2, base, "v2", "date, hour")
    V.publish_partitioned(spark, name, base, "v2")
    assert [r.name for r in spark.table(name).collect()] == ["x2"]
    assert V.table_location(spark, name).rstrip("/").endswith("/v2")
    assert [r[0] for r in V.list_partitions(spark, name).collect()] == ["date=2024-01-01/hour=0"]
    V.publish_partitioned(spark, name, base, "v1")  # rollback: v1's files were kept
    assert sorted(r.name for r in spark.table(name).collect()) == ["x", "y"]


def test_only_occurring_tuples_are_partitions(spark, scratch):
    base = scratch("tuples")
    name = f"default.{unique_name('t')}"
    df = frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 2)])
    V.create_partitioned_table(spark, name, df.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(df, base, "v1", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    assert V.list_partitions(spark, name).count() == 2
    assert V.partition_values(df, ["date", "hour"]).count() == 2
    specs = {(r.date, r.hour): r.row_count for r in V.partition_specs(df, ["date", "hour"]).collect()}
    assert specs == {("2024-01-01", 1): 1, ("2024-01-02", 2): 1}


def test_null_partition_value_is_registered(spark, scratch):
    base = scratch("nulls")
    name = f"default.{unique_name('t')}"
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", None)], "name string, date string")
    V.create_partitioned_table(spark, name, df.schema, ["date"], V.version_path(base, "v0"))
    V.write_version(df, base, "v1", ["date"])
    V.publish_partitioned(spark, name, base, "v1")
    assert sorted(r.name for r in spark.table(name).collect()) == ["a", "b"]
    V.write_version(df.filter(F.col("date").isNotNull()), base, "v2", ["date"])
    V.publish_partitioned(spark, name, base, "v2")
    assert [r.name for r in spark.table(name).collect()] == ["a"]


def test_partition_column_validation(spark, scratch):
    df = frame(spark, [("a", "2024-01-01", 1)])
    for bad in ("", " ", "date,", "nope", []):
        with pytest.raises(ValueError):
            V.write_version(df, scratch("bad"), "v1", bad)
    with pytest.raises(ValueError):
        V.check_partition_columns(df, None)


def test_publish_requires_existing_external_table(spark, scratch):
    with pytest.raises(ValueError):
        V.publish_partitioned(spark, f"default.{unique_name('missing')}", scratch("x"), "v1")
    managed = f"default.{unique_name('managed')}"
    frame(spark, [("a", "2024-01-01", 1)]).write.partitionBy("date", "hour").saveAsTable(managed)
    with pytest.raises(ValueError):
        V.publish_partitioned(spark, managed, scratch("y"), "v1")
    spark.sql(f"DROP TABLE {managed}")


def test_publish_table_follows_schema_changes(spark, scratch):
    base = scratch("plain")
    name = f"default.{unique_name('t')}"
    V.write_version(spark.createDataFrame([("a",)], "id string"), base, "v1")
    V.publish_table(spark, name, base, "v1")
    V.write_version(spark.createDataFrame([("b", 2)], "id string, n int"), base, "v2")
    V.publish_table(spark, name, base, "v2")
    assert [tuple(r) for r in spark.table(name).collect()] == [("b", 2)]
    V.publish_table(spark, name, base, "v1")
    assert [tuple(r) for r in spark.table(name).collect()] == [("a",)]


def test_save_and_empty_table_like(spark, scratch):
    src = spark.createDataFrame([(1, "a")], "id int, name string")
    name = f"keelson_test_db.{unique_name('src')}"
    t = V.save_table(src, name, scratch("saved"))
    assert t.count() == 1
    empty = V.create_empty_table_like(spark, t, f"keelson_test_db.{unique_name('empty')}", scratch("empty"))
    assert empty.count() == 0 and empty.schema == t.schema
    spark.sql("DROP DATABASE keelson_test_db CASCADE")


def test_null_int_partition_republish(spark, scratch):
    base = scratch("nullint")
    name = f"default.{unique_name('t')}"
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-01", None)], "name string, date string, hour int")
    V.create_partitioned_table(spark, name, df.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(df, base, "v1", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    assert sorted(r.name for r in spark.table(name).collect()) == ["a", "b"]
    V.write_version(df.filter("hour IS NOT NULL"), base, "v2", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v2")
    assert [r.name for r in spark.table(name).collect()] == ["a"]


def test_publishing_a_missing_version_changes_nothing(spark, scratch):
    base, name = scratch("missing"), f"default.{unique_name('t')}"
    df = frame(spark, [("x", "2024-05-01", 0), ("y", "2024-05-02", 5)])
    V.create_partitioned_table(spark, name, df.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(df, base, "v1", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    with pytest.raises(ValueError):
        V.publish_partitioned(spark, name, base, "v9")
    V.write_version(df.withColumn("name", F.lit(3)), base, "v2", ["date", "hour"])
    with pytest.raises(ValueError):  # another type
        V.publish_partitioned(spark, name, base, "v2")
    assert sorted(r.name for r in spark.table(name).collect()) == ["x", "y"]
    plain, base = f"default.{unique_name('p')}", scratch("plain")
    V.write_version(df, base, "v1")
    V.publish_table(spark, plain, base, "v1")
    with pytest.raises(ValueError):
        V.publish_table(spark, plain, base, "v9")
    assert spark.table(plain).count() == 2


def test_failure_half_way_serves_the_old_version(spark, scratch, monkeypatch):
    base, name = scratch("half"), f"default.{unique_name('t')}"
    v1 = frame(spark, [("x", "2024-05-01", 0), ("y", "2024-05-02", 5)])
    v2 = frame(spark, [("x2", "2024-05-01", 0), ("z2", "2024-05-03", 1)])
    V.create_partitioned_table(spark, name, v1.schema, ["date", "hour"], V.version_path(base, "v0"))
    V.write_version(v1, base, "v1", ["date", "hour"])
    V.write_version(v2, base, "v2", ["date", "hour"])
    V.publish_partitioned(spark, name, base, "v1")
    in_batches = V._in_batches

    def broken(spark, head, clauses, separator):
        if "DROP" in head:
            raise RuntimeError("metastore went away")
        in_batches(spark, head, clauses, separator)

    calls = []
    monkeypatch.setattr(V, "_in_batches", lambda *a: (calls.append(a), broken(*a) if len(calls) < 3 else in_batches(*a)))
    with pytest.raises(RuntimeError, match="went away"):
        V.publish_partitioned(spark, name, base, "v2")
    monkeypatch.undo()
    assert sorted(r.name for r in spark.table(name).collect()) == ["x", "y"]
    assert V.table_location(spark, name).rstrip("/").endswith("/v1")
    V.publish_partitioned(spark, name, base, "v2")
    assert sorted(r.name for r in spark.table(name).collect()) == ["x2", "z2"]


def test_added_column_shows_and_old_versions_roll_back(spark, scratch):
    base, name = scratch("added"), f"default.{unique_name('t')}"
    v1 = spark.createDataFrame([("x", "2024-05-01")], "name string, date string")
    v2 = spark.createDataFrame([("x", 4, "2024-05-01")], "name string, extra int, date string")
    V.create_partitioned_table(spark, name, v1.schema, ["date"], V.version_path(base, "v0"))
    V.write_version(v1, base, "v1", ["date"])
    V.write_version(v2, base, "v2", ["date"])
    V.publish_partitioned(spark, name, base, "v1")
    V.publish_partitioned(spark, name, base, "v2")
    assert [r.asDict() for r in spark.table(name).collect()] == [{"name": "x", "extra": 4, "date": "2024-05-01"}]
    V.publish_partitioned(spark, name, base, "v1")
    assert [r.asDict() for r in spark.table(name).collect()] == [{"name": "x", "extra": None, "date": "2024-05-01"}]


def test_drop_table_and_database(spark, scratch):
    db = unique_name("keelson_db")
    path = scratch("kept")
    V.save_table(spark.range(2).toDF("id"), f"{db}.kept", path)
    V.save_table(spark.range(2).toDF("id"), f"{db}.gone")
    V.drop_table(spark, f"{db}.gone")
    V.drop_table(spark, f"{db}.gone")
    assert not spark.catalog.tableExists(f"{db}.gone") and spark.catalog.tableExists(f"{db}.kept")
    V.drop_database(spark, db)
    V.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)
    assert spark.read.parquet(path).count() == 2  # an external table's files stay
