from pyspark.sql import functions as F

from keelson.functions.pricing import discount, final_price, price_band
from keelson.operators import quality as Q
from tests.fixtures import METRIC_ROWS, METRIC_SCHEMA, PRICES, PRICE_SCHEMA


def metrics_frame(spark):
    return spark.createDataFrame(METRIC_ROWS, METRIC_SCHEMA)


def as_dict(df):
    return {(r.metric, r.group_key): (r.value, r.text_value) for r in df.collect()}


def test_vehicle_metrics(spark):
    m = as_dict(Q.vehicle_metrics(metrics_frame(spark)))
    assert {k[1]: v[0] for k, v in m.items() if k[0] == "count"} == {"Norwind": 1, "Palmo": 3, None: 1}
    assert {k[1]: v[0] for k, v in m.items() if k[0] == "gear_pos"} == {"5": 1, "0": 2, "-1": 1, "6": 1}
    assert m[("min_date", None)][1] == "2024-02-29" and m[("max_date", None)][1] == "2024-03-02"
    assert {k[1]: v[0] for k, v in m.items() if k[0] == "null_pct"} == {
        "vin": 0.0, "manufacturer": 20.0, "model": 20.0, "year": 0.0}


def test_metrics_read_their_input_once(spark, scratch):
    path = scratch("metrics")
    metrics_frame(spark).write.parquet(path)
    plan = Q.vehicle_metrics(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_null_group_is_null_key_and_percentages(spark):
    df = spark.createDataFrame(
        [("a", None, "D", "2024-01-01"), ("b", "Ford", None, "2024-01-02"), (None, None, "D", None)],
        "vin string, manufacturer string, gearPosition string, date string"
    ).withColumn("model", F.lit("m")).withColumn("year", F.lit(1))
    m = as_dict(Q.vehicle_metrics(df))
    assert m[("count", None)][0] == 2 and m[("count", "Ford")][0] == 1
    assert m[("gear_pos", None)][0] == 1
    assert abs(m[("null_pct", "manufacturer")][0] - 200 / 3) < 1e-9
    assert abs(m[("null_pct", "vin")][0] - 100 / 3) < 1e-9
    np = {r.column_name: r.null_pct for r in Q.null_percentages(df).collect()}
    assert abs(np["manufacturer"] - 200 / 3) < 1e-9


def test_metrics_on_empty_input(spark):
    df = metrics_frame(spark).limit(0)
    m = as_dict(Q.vehicle_metrics(df))
    assert m[("null_pct", "vin")] == (0.0, None)
    assert m[("min_date", None)] == (None, None)
    assert not any(k[0] in ("count", "gear_pos") for k in m)
    assert {r.column_name: r.null_pct for r in Q.null_percentages(df).collect()}["vin"] == 0.0


def test_violation_counts(spark):
    df = spark.createDataFrame([(" a",), ("b",), (None,), ("-12",), ("X",)], "s string")
    assert Q.untrimmed_count(df, "s").first()[0] == 1
    assert Q.gear_violations(df, "s").first()[0] == 3


def test_price_bands_and_discount(spark):
    df = spark.createDataFrame(PRICES, PRICE_SCHEMA).select(
        "name", price_band("price", 15.0, 20.0).alias("band"), discount("price").alias("d"), final_price("price").alias("f"))
    rows = {r.name: r for r in df.collect()}
    assert {n: r.band for n, r in rows.items()} == {
        "spoon": "Low", "pan": "Medium", "oven": "High", "edge low": "Medium", "edge high": "High"}
    assert abs(rows["oven"].d - 40.0) < 1e-9 and abs(rows["oven"].f - 360.0) < 1e-9
    assert abs(rows["spoon"].f - 2.88) < 1e-9
    assert spark.createDataFrame([(None,)], "price double").select(price_band("price")).first()[0] == "High"


def test_graph_metrics(spark):
    from keelson.operators.graph import merged_graph
    from tests.fixtures import retail
    g = merged_graph(retail(spark))
    m = as_dict(Q.graph_metrics(g.vertices, g.edges))
    assert m[("total_vertices", None)][0] == 6 and m[("total_edges", None)][0] == 5
    assert m[("customers_in", "Brno")][0] == 1 and m[("products_in", "Floor")][0] == 1
    assert m[("min_date", None)][1] == "2024-01-30" and m[("max_date", None)][1] == "2024-03-08"
    empty = as_dict(Q.graph_metrics(g.vertices.limit(0), g.edges.limit(0)))
    assert empty == {("total_vertices", None): (0.0, None), ("total_edges", None): (0.0, None),
                     ("min_date", None): (None, None), ("max_date", None): (None, None)}
