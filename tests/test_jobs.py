import pytest

from keelson.operators.compare import compare_frames, frames_equal
from keelson.plans.job import parse_properties, run_job
from keelson.plans.graph_job import PurchaseGraphJob
from keelson.plans.vehicle_job import VehicleJob
from keelson.session import unique_name
from keelson.sources.tables import create_csv_table, read_csv_declared, register_view
from tests.fixtures import COMPONENTS, CSV_DDL, CSV_TEXT, retail


def test_parse_properties():
    props = parse_properties(["a=1", "b=x=y", "bad", "a=2"])
    assert props == {"a": "2", "b": "x=y"}


def csv_source(spark, scratch):
    path = scratch("csv")
    spark.createDataFrame([(line,) for line in CSV_TEXT.strip().split("\n")], "v string").coalesce(1).write.text(path)
    return path


def test_declared_csv_table_and_bad_int(spark, scratch):
    path = csv_source(spark, scratch)
    t = create_csv_table(spark, f"default.{unique_name('events')}", CSV_DDL, path)
    assert t.count() == 4 and dict(t.dtypes)["timestamp"] == "bigint"
    bad = scratch("badcsv")
    spark.createDataFrame([("id,year",), ("1,notanint",)], "v string").coalesce(1).write.text(bad)
    row = read_csv_declared(spark, bad, "id INT, year INT").first()
    assert row.id == 1 and row.year is None


def test_vehicle_job_end_to_end_with_metrics_table(spark, scratch):
    path = csv_source(spark, scratch)
    src = f"default.{unique_name('events')}"
    create_csv_table(spark, src, CSV_DDL, path)
    root = scratch("job")
    props = {"source-table": src, "target-table": f"default.{unique_name('out')}", "base-path": f"{root}/data",
             "version": "v001", "partition-columns": "date,hour", "time-zone": "UTC", "create-target": "true",
             "metrics-reporter": "table", "metrics-path": f"{root}/metrics", "job-id": "j1"}
    run = run_job(spark, VehicleJob(), props)
    assert run.status == "SUCCESS" and run.record_counts["processed"] == 3
    out = spark.table(props["target-table"])
    assert sorted(r.gearPosition for r in out.collect()) == ["0", "2", "4"]
    assert spark.sql(f"SHOW PARTITIONS {props['target-table']}").count() == 3
    assert {r.manufacturer for r in out.collect()} == {"Tarn", "Palmo"}
    business = spark.read.parquet(f"{root}/metrics/business_metrics")
    assert business.filter("metric = 'count' AND group_key = 'Palmo'").first().value == 2
    assert set(run.timings) == {"logic", "output", "metrics"}
    failed = run_job(spark, VehicleJob(), {**props, "partition-columns": "", "job-id": "j2"}, raise_errors=False)
    assert failed.status == "FAILED" and "ValueError" in failed.error_details
    runs = {r.job_id: r for r in spark.read.parquet(f"{root}/metrics/runs").collect()}
    assert runs["j1"].status == "SUCCESS" and runs["j2"].status == "FAILED" and runs["j2"].end_time is not None
    with pytest.raises(ValueError):
        run_job(spark, VehicleJob(), {**props, "partition-columns": "nope"})


def test_graph_job_publishes_tables(spark, scratch):
    from keelson.plans.graph_job import RESULT_TABLES, TABLE_DEFAULTS
    inputs = retail(spark)
    props = {}
    for key, (prop, _) in TABLE_DEFAULTS.items():
        view = unique_name(key)
        register_view(inputs[key], view)
        props[prop] = view
    for label, (prop, _) in RESULT_TABLES.items():
        props[prop] = f"default.{unique_name(label)}"
    props.update({"target-vertices-table": f"default.{unique_name('v')}",
                  "target-edges-table": f"default.{unique_name('e')}", "top-k": "2",
                  "base-path": scratch("graphjob"), "version": "v001", "metrics-reporter": "console"})
    run = run_job(spark, PurchaseGraphJob(), props)
    assert run.status == "SUCCESS" and run.record_counts["vertices"] == 6 and run.record_counts["edges"] == 5
    assert spark.table(props["target-vertices-table"]).count() == 6
    assert spark.table(props["target-edges-table"]).columns[:3] == ["purchase_id", "src", "dst"]
    assert spark.table(props["pagerank-table"]).count() == 6
    assert {r.id: r.component for r in spark.table(props["components-table"]).collect()} == COMPONENTS
    assert sorted(r.id for r in spark.table(props["top-customers-table"]).collect()) == ["c:7", "c:8"]
    assert sorted(r.id for r in spark.table(props["top-products-table"]).collect()) == ["p:12", "p:7"]


class _Manual:
    """A job whose metrics frame is given."""

    def __init__(self, make):
        self.make = make

    def logic(self, spark, props):
        return spark.range(3)

    def output(self, spark, df, props):
        return {"processed": df.count()}

    def metrics(self, spark, df, props):
        return self.make(spark)


def test_failing_metrics_are_reported(spark, scratch):
    root = scratch("failing")
    job = _Manual(lambda s: s.range(1).selectExpr("raise_error('metrics broke') AS metric"))
    props = {"metrics-reporter": "table", "metrics-path": root, "job-id": "m1"}
    run = run_job(spark, job, props, raise_errors=False)
    assert run.status == "FAILED" and run.record_counts == {"processed": 3}
    row = spark.read.parquet(f"{root}/runs").first()
    assert (row.job_id, row.status) == ("m1", "FAILED") and row.end_time is not None


def test_console_prints_every_metric(spark, capsys):
    job = _Manual(lambda s: s.range(120).selectExpr("concat('metric-', id) AS metric"))
    assert run_job(spark, job).status == "SUCCESS"
    printed = capsys.readouterr().out
    assert all(f"metric-{i}\n" in printed for i in range(120))


def test_compare_frames_on_any_column_names(spark):
    names = ["l", "r", "_l", "left_count", "RIGHT_COUNT", "a`b"]
    a = spark.createDataFrame([(1, 2, 3, 4, 5, 6), (1, 2, 3, 4, 5, 7)], names)
    b = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], names)
    row = compare_frames(a, b).first()
    assert (row.left_rows, row.right_rows, row.left_only, row.right_only) == (2, 1, 1, 0)


def test_shared_folder_is_needed_off_a_local_master(monkeypatch):
    from types import SimpleNamespace

    from keelson.session import shared_dir
    sc = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077", applicationId="app-x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc))


def test_compare_frames(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (1, "x")], "id int, v string")
    c = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert frames_equal(a, b)
    row = compare_frames(a, c).first()
    assert (row.left_only, row.right_only) == (1, 0)
    assert not compare_frames(a, spark.createDataFrame([(1,)], "id long")).first().schema_equal


def test_cli_rejects_unknown_job():
    from keelson.__main__ import load_job, main
    assert main([]) == 1
    with pytest.raises(SystemExit):
        load_job("nope")
    assert type(load_job("vehicle")).__name__ == "VehicleJob"
    assert type(load_job("keelson.plans.graph_job:PurchaseGraphJob")).__name__ == "PurchaseGraphJob"


def test_compare_frames_counts_duplicates_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "y"), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, "y"), (2, "y")], "id int, v string")
    row = compare_frames(a, b).first()
    assert (row.left_rows, row.right_rows, row.left_only, row.right_only) == (4, 3, 2, 1)
    assert (a.exceptAll(b).count(), b.exceptAll(a).count()) == (2, 1)
    empty = compare_frames(a.limit(0), b.limit(0)).first()
    assert (empty.left_rows, empty.left_only, empty.right_only) == (0, 0, 0)


def test_a_failing_reporter_keeps_the_jobs_own_error(spark):
    class Broken:
        def business(self, *args):
            raise KeyError("business")

        def run(self, *args):
            raise OSError("disk full")

    with pytest.raises(KeyError, match="business") as caught:
        run_job(spark, _Manual(lambda s: s.range(1)), reporter=Broken())
    assert "disk full" in caught.value.__notes__[0]

    class Late(Broken):
        def business(self, *args):
            pass

    with pytest.raises(OSError, match="disk full"):
        run_job(spark, _Manual(lambda s: s.range(1)), reporter=Late())
