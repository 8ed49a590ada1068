"""Data-quality metrics as DataFrames (never collected on the driver).

Long format everywhere: one row per (metric, group_key) with a numeric
``value`` and a ``text_value`` for date-like metrics. A null group stays a
null ``group_key`` instead of the string "null".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.checks import is_not_numeric, is_untrimmed

METRIC_SCHEMA = "metric string, group_key string, value double, text_value string"
_METRIC_ARRAY = "array<struct<metric:string,group_key:string,value:double,text_value:string>>"

# The vehicle job's key columns for null percentages.
VEHICLE_KEY_COLUMNS = ("vin", "manufacturer", "model", "year")


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def null_percentages(df: DataFrame, columns: Sequence[str] = VEHICLE_KEY_COLUMNS) -> DataFrame:
    """(column_name, null_pct): 100 * nulls / rows, 0.0 for an empty frame.

    One global aggregate (partial per task, one row shuffled), then unpivot.
    """
    total = F.count(F.lit(1))
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)]
    one = df.agg(total.alias("total"), *aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("nulls"))
        for i, c in enumerate(columns)
    ]))
    return one.select("total", rows).select(
        "column_name",
        F.coalesce(F.try_divide(F.col("nulls") * 100.0, F.col("total")), F.lit(0.0)).alias("null_pct"),
    )


def count_by(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value of ``column``; null is its own group."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def value_range(df: DataFrame, column: str, low: str = "min_value", high: str = "max_value") -> DataFrame:
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def violation_count(df: DataFrame, predicate: Column, name: str = "violations") -> DataFrame:
    """Rows where ``predicate`` is true (null counts as no violation)."""
    return df.agg(F.count_if(F.coalesce(predicate, F.lit(False))).alias(name))


def gear_violations(df: DataFrame, column: str = "gearPosition") -> DataFrame:
    return violation_count(df, is_not_numeric(column))


def untrimmed_count(df: DataFrame, column: str = "manufacturer") -> DataFrame:
    return violation_count(df, is_untrimmed(column))


def _row(metric: str, key: Column, value: Column, text: Column) -> Column:
    return F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("group_key"),
                    value.cast("double").alias("value"), text.cast("string").alias("text_value"))


def _null_d() -> Column:
    return F.lit(None).cast("double")


def _null_s() -> Column:
    return F.lit(None).cast("string")


def _with_zero_row(counts: DataFrame) -> DataFrame:
    """``counts`` plus a row without keys and with count 0, so that totals exist for empty input too."""
    zero = counts.sparkSession.range(1).select(*[
        (F.lit(0) if c == "n" else F.lit(None)).cast(t).alias(c) for c, t in counts.dtypes])
    return counts.unionByName(zero)


def vehicle_states(df: DataFrame, key_columns: Sequence[str] = VEHICLE_KEY_COLUMNS, manufacturer: str = "manufacturer",
                   gear: str = "gearPosition", date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Mergeable states of the vehicle metrics: one short row for each manufacturer and gear (and values of ``by``).

    ``n`` rows, ``null_i`` nulls of the i-th key column, and the range of the
    date as day numbers. States of disjoint rows add up, so those of rows
    that don't change can be kept (``sinks.delta``). The input is read once;
    values are of fixed width, so there is no sort, and a hot value is
    pre-aggregated in every task.
    """
    day = F.unix_date(F.to_date(F.col(date)))
    return df.groupBy(*by, F.col(manufacturer).alias("m"), F.col(gear).alias("g")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(key_columns)],
        F.min(day).alias("low"), F.max(day).alias("high"))


def vehicle_metrics_of(states: DataFrame, key_columns: Sequence[str] = VEHICLE_KEY_COLUMNS) -> DataFrame:
    """The vehicle metrics of any union of states: a GROUPING SETS pass over their few rows."""
    nulls = [f"null_{i}" for i in range(len(key_columns))]
    sets = _with_zero_row(states.select("m", "g", "n", *nulls, "low", "high")).groupingSets([["m"], ["g"], []], "m", "g").agg(
        F.grouping_id().alias("set"), F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in nulls],
        F.min("low").alias("low"), F.max("high").alias("high"))
    pct = [_row("null_pct", F.lit(c), F.coalesce(F.try_divide(F.col(n) * 100.0, F.col("n")), F.lit(0.0)), _null_s())
           for c, n in zip(key_columns, nulls)]
    text = lambda c: F.date_from_unix_date(F.col(c)).cast("string")
    # grouping_id: one bit a column, the first the high one, 0 = grouped by it
    rows = (F.when((F.col("set") == 0b01) & (F.col("n") > 0), F.array(_row("count", F.col("m"), F.col("n"), _null_s())))
            .when((F.col("set") == 0b10) & (F.col("n") > 0), F.array(_row("gear_pos", F.col("g"), F.col("n"), _null_s())))
            .when(F.col("set") == 0b11, F.array(*pct, _row("min_date", _null_s(), _null_d(), text("low")),
                                                _row("max_date", _null_s(), _null_d(), text("high")))))
    return sets.select(F.inline(F.coalesce(rows, F.array().cast(_METRIC_ARRAY))))


def vehicle_metrics(df: DataFrame, key_columns: Sequence[str] = VEHICLE_KEY_COLUMNS,
                    manufacturer: str = "manufacturer", gear: str = "gearPosition",
                    date: str = "date") -> DataFrame:
    """All vehicle business metrics as one long table: ``null_pct`` per key
    column, ``count`` per manufacturer, ``gear_pos`` per gear code,
    ``min_date`` / ``max_date`` (``date``: a date, or yyyy-MM-dd text).

    One scan and hash aggregate (``vehicle_states``) gives everything.
    """
    return vehicle_metrics_of(vehicle_states(df, key_columns, manufacturer, gear, date), key_columns)


def graph_metrics(vertices: DataFrame, edges: DataFrame, vertex_type: str = "vertex_type",
                  location: str = "location", category: str = "category",
                  relationship: str = "relationship", purchase_date: str = "purchase_date") -> DataFrame:
    """Graph business metrics, each input read once: ``total_vertices``,
    ``customers_in`` per location and ``products_in`` per category from one
    hash aggregate over the vertices and a GROUPING SETS pass over its few
    rows; ``total_edges`` and the ``min_date`` / ``max_date`` of PURCHASED
    edges from one keyless aggregate over the edges."""
    few = vertices.groupBy(F.col(vertex_type).alias("t"), F.col(location).alias("l"), F.col(category).alias("c")).agg(
        F.count(F.lit(1)).alias("n"))
    sets = _with_zero_row(few).groupingSets([["t", "l"], ["t", "c"], []], "t", "l", "c").agg(
        F.grouping_id().alias("set"), F.sum("n").alias("n"))
    rows = (F.when((F.col("set") == 0b001) & (F.col("t") == "customer"), F.array(_row("customers_in", F.col("l"), F.col("n"), _null_s())))
            .when((F.col("set") == 0b010) & (F.col("t") == "product"), F.array(_row("products_in", F.col("c"), F.col("n"), _null_s())))
            .when(F.col("set") == 0b111, F.array(_row("total_vertices", _null_s(), F.col("n"), _null_s()))))
    purchased = F.col(relationship) == "PURCHASED"
    e = edges.agg(
        F.count(F.lit(1)).alias("_ne"),
        F.min(F.when(purchased, F.col(purchase_date))).alias("_min"),
        F.max(F.when(purchased, F.col(purchase_date))).alias("_max"),
    )
    totals = e.select(F.inline(F.array(
        _row("total_edges", _null_s(), F.col("_ne"), _null_s()),
        _row("min_date", _null_s(), _null_d(), F.col("_min")),
        _row("max_date", _null_s(), _null_d(), F.col("_max")))))
    return totals.unionByName(sets.select(F.inline(F.coalesce(rows, F.array().cast(_METRIC_ARRAY)))))
