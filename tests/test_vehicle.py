from pyspark.sql import functions as F

from keelson.functions import epoch_ms_date, epoch_ms_hour, normalize_gear
from keelson.operators.vehicle import clean_vehicle_events
from tests.fixtures import VEHICLES_JSON


def vehicles(spark, scratch):
    path = scratch("vehicles_json")
    spark.createDataFrame([(line,) for line in VEHICLES_JSON], "value string").write.text(path)
    from keelson.sources.tables import read_files
    return read_files(spark, path, "json")


def test_clean_drops_null_vin_trims_and_adds_partitions(spark, scratch):
    raw = vehicles(spark, scratch)
    out = clean_vehicle_events(raw, "UTC")
    rows = {r.vin: r for r in out.collect()}
    assert set(rows) == {"KT0001", "KT0002", "KT0003", "KT0005", ""} and raw.count() == 6
    assert [rows[v].manufacturer for v in ("KT0002", "KT0003", "KT0005", "")] == ["Palmo", "Palmo", None, "Tarn"]
    assert {v: r.gearPosition for v, r in rows.items()} == {"KT0001": "5", "KT0002": "0", "KT0003": "-1", "KT0005": "6", "": "4"}
    assert (rows["KT0001"].date, rows["KT0001"].hour) == ("2024-02-29", 23)
    assert (rows["KT0003"].date, rows["KT0003"].hour) == ("2024-03-01", 0)
    assert (rows[""].date, rows[""].hour) == ("2024-03-01", 1)
    assert dict(out.dtypes)["hour"] == "int" and dict(out.dtypes)["date"] == "string"
    assert set(raw.columns) <= set(out.columns)


def test_gear_codes_case_sensitive_and_passthrough(spark):
    df = spark.createDataFrame([("D",), ("R",), ("N",), ("P",), ("d",), ("3",), ("X",), (None,)], "g string")
    got = [r[0] for r in df.select(normalize_gear("g")).collect()]
    assert got == ["4", "-1", "0", "0", "d", "3", "X", None]


def test_date_hour_zone_and_truncation(spark):
    df = spark.createDataFrame([(1709251199750,), (-1,), (0,), (None,)], "ts long")
    rows = df.select(epoch_ms_date("ts", "UTC").alias("d"), epoch_ms_hour("ts", "UTC").alias("h"),
                     epoch_ms_date("ts", "America/New_York").alias("dny"),
                     epoch_ms_hour("ts", "Asia/Kolkata").alias("hin")).collect()
    assert (rows[0].d, rows[0].h, rows[0].dny, rows[0].hin) == ("2024-02-29", 23, "2024-02-29", 5)
    # -1 ms truncates toward zero to second 0 (1970-01-01), like a cast of ms / 1000
    assert (rows[1].d, rows[1].h) == ("1970-01-01", 0)
    assert rows[3].d is None and rows[3].h is None


def test_session_zone_is_default(spark):
    df = spark.createDataFrame([(1709251199750,)], "ts long")
    assert df.select(epoch_ms_hour("ts")).first()[0] == 23  # the test session runs in UTC
