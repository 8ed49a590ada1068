"""Adapters: shape the driver's TPC-H-like tables like the jobs' inputs.

They inject what the driver data lacks (null vins, untrimmed and null
manufacturers, letter gears, overlapping new batches), deterministically
from the row keys, so Spark and the SQL oracle see the same rows. Every
adapter reads its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.functions.vehicle import ntz_epoch_ms

# Of each 15 ids in a row, the first 12 exist and the last 5 are
# in the new batch (so 2 overlap); purchases before 2001-01-01 exist, purchases
# from 2000-10-01 on are the new batch.
ID_CYCLE, EXISTING_BELOW, NEW_FROM_ID = 15, 12, 10
EXISTING_BEFORE = "2001-01-01 00:00:00"
NEW_FROM = "2000-10-01 00:00:00"

# Gear letter per event_id % 7 (5 -> 'X' stays invalid, 6 -> null).
GEAR_BY_MOD7 = {0: "D", 1: "R", 2: "N", 3: "P", 4: "3", 5: "X"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(ts: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{ts}'")


def vehicle_events(events: DataFrame) -> DataFrame:
    """events -> vehicle telemetry rows (id, vin, manufacturer, model, year,
    gearPosition, timestamp epoch-ms)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    gear = F.when(eid % 7 == 0, F.lit(GEAR_BY_MOD7[0]))
    for k in range(1, 6):
        gear = gear.when(eid % 7 == k, F.lit(GEAR_BY_MOD7[k]))
    return events.select(
        eid.alias("id"),
        F.when(eid % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("VIN"), uid.cast("string"))).alias("vin"),
        F.when(eid % 25 == 0, F.lit(None).cast("string"))
         .when(eid % 2 == 0, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
         .otherwise(F.col("event_type")).alias("manufacturer"),
        F.when(eid % 20 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("M"), (uid % 5).cast("string"))).alias("model"),
        (F.lit(2015) + uid % 8).cast("int").alias("year"),
        gear.otherwise(F.lit(None).cast("string")).alias("gearPosition"),
        ntz_epoch_ms("ts").alias("timestamp"),
    )


def _existing(key: str) -> Column:
    return F.col(key) % ID_CYCLE < EXISTING_BELOW


def _new(key: str) -> Column:
    return F.col(key) % ID_CYCLE >= NEW_FROM_ID


def all_customers(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                           F.col("c_mktsegment").alias("location"))


def customers(customer: DataFrame) -> DataFrame:
    return all_customers(customer.filter(_existing("c_custkey")))


def new_customers(customer: DataFrame) -> DataFrame:
    return all_customers(customer.filter(_new("c_custkey"))).withColumn("name", F.concat("name", F.lit(" v2")))


def all_products(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
                       F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))


def products(part: DataFrame) -> DataFrame:
    return all_products(part.filter(_existing("p_partkey")))


def new_products(part: DataFrame) -> DataFrame:
    return all_products(part.filter(_new("p_partkey"))).withColumn("name", F.concat("name", F.lit(" v2")))


def _before() -> Column:
    return F.col("o_orderdate") < _ntz(EXISTING_BEFORE)


def _from() -> Column:
    return F.col("o_orderdate") >= _ntz(NEW_FROM)


def dated_purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """All purchases, with ``o_orderdate`` last: what existing purchases and the new batch are chosen by."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("purchase_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("purchase_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("amount"),
        "o_orderdate",
    )


def _purchases(lineitem: DataFrame, orders: DataFrame, order_filter: Column) -> DataFrame:
    return dated_purchases(lineitem, orders.filter(order_filter)).drop("o_orderdate")


def all_purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return _purchases(lineitem, orders, F.lit(True))


def purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return _purchases(lineitem, orders, _before())


def new_purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return _purchases(lineitem, orders, _from())


def order_chains(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of a graph with many components and long paths:
    each order is linked to the same customer's next order by key."""
    ids = F.concat(F.lit("o:"), F.col("o_orderkey").cast("string"))
    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    edges = orders.select(ids.alias("src"), F.concat(F.lit("o:"), following.cast("string")).alias("dst"))
    return orders.select(ids.alias("id")), edges.filter("dst IS NOT NULL")


def retail_inputs(spark: SparkSession, sf_dir: str, dated: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six inputs of the purchase-graph job, from the driver's tables.

    ``dated``: ``dated_purchases`` of the same tables, stored; else each reader of purchases joins lineitem
    and orders anew, and a merge reads the existing purchases twice and the batch once.
    """
    customer = read_table(spark, sf_dir, "customer")
    part = read_table(spark, sf_dir, "part")
    if dated is None:
        lineitem = read_table(spark, sf_dir, "lineitem")
        orders = read_table(spark, sf_dir, "orders")
        existing, batch = purchases(lineitem, orders), new_purchases(lineitem, orders)
    else:
        existing, batch = dated.filter(_before()).drop("o_orderdate"), dated.filter(_from()).drop("o_orderdate")
    return {
        "customers": customers(customer),
        "products": products(part),
        "purchases": existing,
        "new_customers": new_customers(customer),
        "new_products": new_products(part),
        "new_purchases": batch,
    }
