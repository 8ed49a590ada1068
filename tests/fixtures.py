"""Small hand-made inputs of the tests, with what the operators must make of them."""

# Six events: one without vin, two untrimmed makers, one without maker, a letter gear on a kept row.
# 2024-02-29 23:59:59.750 UTC is 1709251199750 ms; 2024-03-01 00:00:00 UTC is 1709251200000 ms.
VEHICLES_JSON = [
    '{"vin":"KT0001","manufacturer":"Norwind","year":2021,"model":"Fjell","timestamp":1709251199750,"velocity":64,"gearPosition":"5"}',
    '{"vin":"KT0002","manufacturer":"  Palmo","year":2019,"model":"Brisa","timestamp":1709251199750,"velocity":0,"gearPosition":"P"}',
    '{"vin":"KT0003","manufacturer":"Palmo ","year":2022,"model":"Onda","timestamp":1709251200000,"velocity":12,"gearPosition":"R"}',
    '{"vin":null,"manufacturer":"Norwind","year":2020,"model":"Fjell","timestamp":1709251200000,"velocity":33,"gearPosition":"N"}',
    '{"vin":"KT0005","manufacturer":null,"year":2018,"model":null,"timestamp":1709254800000,"velocity":80,"gearPosition":"6"}',
    '{"vin":"","manufacturer":"Tarn","year":2023,"model":"Lough","timestamp":1709254800000,"velocity":5,"gearPosition":"D"}',
]

METRIC_ROWS = [
    ("KT0001", "Norwind", "Fjell", 2021, "5", "2024-02-29"),
    ("KT0002", "Palmo", "Brisa", 2019, "0", "2024-02-29"),
    ("KT0003", "Palmo", "Onda", 2022, "-1", "2024-03-01"),
    ("KT0005", None, None, 2018, "6", "2024-03-01"),
    ("", "Palmo", "Onda", 2023, "0", "2024-03-02"),
]
METRIC_SCHEMA = "vin string, manufacturer string, model string, year int, gearPosition string, date string"

CSV_TEXT = """id,vin,manufacturer,model,year,gearPosition,timestamp
11,KT0011, Tarn ,Lough,2017,D,1709251199750
12,KT0012,Palmo,Brisa,2018,2,1709251200000
13,,Norwind,Fjell,2019,P,1709251200000
14,KT0014,Palmo,Onda,2020,N,1709337600000
"""
CSV_DDL = "id INT, vin STRING, manufacturer STRING, model STRING, year INT, gearPosition STRING, timestamp BIGINT"

# Customer and product keys overlap (7, 8); one pair bought twice.
CUSTOMERS = [(7, "Ines", "Porto"), (8, "Tomas", "Brno"), (9, "Oluchi", "Enugu")]
CUSTOMER_SCHEMA = "customer_id int, name string, location string"
PRODUCTS = [(7, "Kettle", "Kitchen", 40.0), (8, "Lamp", "Light", 25.0), (12, "Rug", "Floor", 90.0)]
PRODUCT_SCHEMA = "product_id int, name string, category string, price double"
PURCHASES = [(501, 7, 7, "2024-02-03", 1, 40.0), (502, 7, 8, "2024-02-05", 2, 50.0), (503, 8, 7, "2024-02-11", 1, 40.0),
             (504, 9, 12, "2024-01-30", 1, 90.0), (505, 9, 12, "2024-03-08", 3, 270.0)]
PURCHASE_SCHEMA = "purchase_id int, customer_id int, product_id int, purchase_date string, quantity int, amount double"
# PageRank before scaling: each customer 0.15; each product 0.15 + 0.85 * (shares of 0.15).
RAW_RANKS = {"c:7": 0.15, "c:8": 0.15, "c:9": 0.15, "p:7": 0.34125, "p:8": 0.21375, "p:12": 0.2775}
COMPONENTS = {"c:7": "c:7", "c:8": "c:7", "p:7": "c:7", "p:8": "c:7", "c:9": "c:9", "p:12": "c:9"}
# A new batch: a known customer and product with other values, and new ones; a known and a new pair.
NEW_CUSTOMERS = [(9, "Oluchi B.", "Lagos"), (10, "Noor", "Aden")]
NEW_PRODUCTS = [(12, "Rug XL", "Floor", 140.0), (13, "Vase", "Floor", 30.0)]
NEW_PURCHASES = [(601, 7, 8, "2024-04-01", 1, 25.0), (602, 10, 13, "2024-04-02", 1, 30.0), (603, 10, 13, "2024-04-03", 1, 30.0)]

PRICES = [("spoon", 3.2), ("pan", 18.0), ("oven", 400.0), ("edge low", 15.0), ("edge high", 20.0)]
PRICE_SCHEMA = "name string, price double"


def retail(spark, new_customers=(), new_products=(), new_purchases=()):
    return {
        "customers": spark.createDataFrame(CUSTOMERS, CUSTOMER_SCHEMA),
        "products": spark.createDataFrame(PRODUCTS, PRODUCT_SCHEMA),
        "purchases": spark.createDataFrame(PURCHASES, PURCHASE_SCHEMA),
        "new_customers": spark.createDataFrame(list(new_customers), CUSTOMER_SCHEMA),
        "new_products": spark.createDataFrame(list(new_products), PRODUCT_SCHEMA),
        "new_purchases": spark.createDataFrame(list(new_purchases), PURCHASE_SCHEMA),
    }
