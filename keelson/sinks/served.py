"""Served tables: a name that readers use, and the one version that it shows.

The name is a view over the catalog table of one version. Publishing first
registers a new table for the version, with all its partitions, where no reader
looks; then one statement replaces the view, and with it rows, partitions and
schema at once. The view's properties say what it shows, so the pointer and its
description can't differ. A failure before that statement changes nothing that
anyone sees.

A ``PublishLog`` is an append-only record beside it: what each publish served,
since when, with which schema, partition tuples and row counts. It answers
"the table as of a time", and rolls back to what was served before. An entry is
written before the switch; if the switch then fails, or never came, the entry is
marked failed by another one, at the latest by the next publish.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.sinks import versioned as V

# Properties of the view that a served name is.
_PATH, _VERSION, _BASE, _TABLE, _ID, _COLUMNS = (
    f"keelson.{k}" for k in ("path", "version", "base", "table", "publish-id", "partition-columns"))


@dataclass(frozen=True)
class Serving:
    """What a served name shows."""

    path: str
    base: str
    version: str
    table: str
    publish_id: str
    partition_columns: list[str]


def serving(spark: SparkSession, name: str) -> Serving | None:
    """What ``name`` shows; None if it isn't a served name."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType.upper() != "VIEW":
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _TABLE not in props:
        return None
    return Serving(props[_PATH], props[_BASE], props[_VERSION], props[_TABLE], props[_ID], json.loads(props[_COLUMNS]))


def create_served(spark: SparkSession, name: str, schema: StructType, partition_columns: Sequence[str] = ()) -> None:
    """A served name that shows nothing yet, with ``schema`` (partition columns last)."""
    if spark.catalog.tableExists(name):
        return
    V._ensure_database(spark, name)
    publish_id = _new_id()
    table = _version_table(name, "empty", publish_id)
    ordered = _ordered(schema, partition_columns)
    V.create_empty_table_like(spark, spark.createDataFrame([], ordered), table)
    _show(spark, name, Serving("", "", "", table, publish_id, list(partition_columns)), ordered, ordered)


def _new_id() -> str:
    return uuid.uuid4().hex[:12]


def _ordered(schema: StructType, partition_columns: Sequence[str]) -> StructType:
    return StructType([f for f in schema.fields if f.name not in partition_columns] + [schema[c] for c in partition_columns])


def _version_table(name: str, version: str, publish_id: str) -> str:
    return f"{name}__{re.sub(r'[^0-9A-Za-z]', '_', version)}_{publish_id}"


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _show(spark: SparkSession, name: str, what: Serving, has: StructType, shown: StructType) -> None:
    """The switch: one statement. Columns that the version lacks read as null."""
    there = set(has.names)
    columns = ", ".join(_quoted(f.name) if f.name in there else
                        f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}" for f in shown.fields)
    props = ", ".join(f"{V._sql_str(k)} = {V._sql_str(v)}" for k, v in (
        (_PATH, what.path), (_BASE, what.base), (_VERSION, what.version), (_TABLE, what.table), (_ID, what.publish_id),
        (_COLUMNS, json.dumps(what.partition_columns))))
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({props}) AS SELECT {columns} FROM {what.table}")


@dataclass(frozen=True)
class VersionFiles:
    """A version as it lies on disk: its schema as read, and its partition directories (``col=value/..``)."""

    path: str
    schema: StructType
    partitions: list[str]


def version_on_disk(spark: SparkSession, path: str, partition_columns: Sequence[str]) -> VersionFiles:
    """One listing of the version's files, which Spark spreads over tasks where there are many; no data is read."""
    try:
        df = spark.read.parquet(path)
        files = df.inputFiles()
    except AnalysisException as missing:
        raise ValueError(f"no version at {path}: nothing is published") from missing
    if not files:
        raise ValueError(f"no version at {path}: nothing is published")
    depth = len(partition_columns)
    tuples = sorted({"/".join(unquote(f).rsplit("/", depth + 1)[1:-1]) for f in files}) if depth else []
    keys = [[p.split("=", 1)[0] for p in t.split("/")] for t in tuples]
    if any(k != list(partition_columns) for k in keys):
        raise ValueError(f"version {path} isn't partitioned by {list(partition_columns)}: nothing is published")
    return VersionFiles(path, df.schema, tuples)


def _register(spark: SparkSession, table: str, found: VersionFiles, schema: StructType, partition_columns: Sequence[str]) -> None:
    by = f" PARTITIONED BY ({', '.join(map(_quoted, partition_columns))})" if partition_columns else ""
    spark.sql(f"CREATE TABLE {table} ({V.ddl_columns(schema)}) USING parquet{by} LOCATION {V._sql_str(found.path)}")
    V._in_batches(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS", V._clauses(found.partitions, found.path), " ")


def _served_schema(found: VersionFiles, served: StructType, partition_columns: Sequence[str], keep_columns: bool) -> StructType:
    """The columns that the name will show: the version's, and with ``keep_columns`` those it has shown so far."""
    own = [f for f in found.schema.fields if f.name not in partition_columns]
    known = {f.name: f.dataType for f in served.fields}
    clash = [f.name for f in own if keep_columns and f.name in known and known[f.name] != f.dataType]
    if clash:
        raise ValueError(f"version {found.path} changes the type of {clash}: nothing is published")
    if not keep_columns:
        return StructType(own + [found.schema[c] for c in partition_columns])
    new = [f for f in own if f.name not in known]
    kept = [f for f in served.fields if f.name not in partition_columns]
    return StructType(kept + new + [served[c] for c in partition_columns])


def publish(spark: SparkSession, name: str, base: str, version: str, partition_columns: Sequence[str] | None = None,
            keep_columns: bool = True, log: "PublishLog | None" = None, kind: str = "publish") -> Serving:
    """Show ``{base}/{version}`` under ``name``, in one statement.

    ``name`` must be a served one, or not exist yet. The version must exist and
    be partitioned by ``partition_columns`` (by default those that the name is
    partitioned by now). With ``keep_columns`` types of shared columns must
    stay, and columns that only the name has stay and read as null; without, the
    name takes the version's schema.
    """
    before = serving(spark, name)
    if before is None and spark.catalog.tableExists(name):
        raise ValueError(f"{name} is a table, not a served name")
    if partition_columns is None:
        partition_columns = before.partition_columns if before else []
    columns = list(partition_columns)
    found = version_on_disk(spark, V.version_path(base, version), columns)
    served = spark.table(name).schema if before else _ordered(found.schema, columns)
    shown = _served_schema(found, served, columns, keep_columns and before is not None)
    own = StructType([f for f in shown.fields if f.name in set(found.schema.names)])
    V._ensure_database(spark, name)
    publish_id = _new_id()
    what = Serving(found.path, base, version, _version_table(name, version, publish_id), publish_id, columns)
    if log is not None:
        log.settle(name, before)
        log.begin(name, what, kind, shown, columns)
    try:
        _register(spark, what.table, found, own, columns)
        _show(spark, name, what, own, shown)
    except Exception:
        if log is not None:
            log.failed(name, publish_id)
        spark.sql(f"DROP TABLE IF EXISTS {what.table}")
        raise
    # the table before stays for readers that have just begun; older ones go, their files stay
    for old in version_tables(spark, name, {what.table, before.table if before else what.table}):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return what


def publish_registered(spark: SparkSession, name: str, base: str, version: str,
                       register: Callable[[str, str], StructType]) -> Serving:
    """Show a version under ``name`` that ``register(version, table)`` makes a table of; its schema is what is shown."""
    before = serving(spark, name)
    if before is None and spark.catalog.tableExists(name):
        raise ValueError(f"{name} is a table, not a served name")
    publish_id = _new_id()
    what = Serving(V.version_path(base, version), base, version, _version_table(name, version, publish_id), publish_id, [])
    try:
        schema = register(version, what.table)
        _show(spark, name, what, schema, schema)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {what.table}")
        raise
    for old in version_tables(spark, name, {what.table, before.table if before else what.table}):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return what


def version_tables(spark: SparkSession, name: str, but: set[str]) -> list[str]:
    """The version tables of ``name`` that are registered, without those of ``but``."""
    *db, short = name.split(".")
    where = f" IN {'.'.join(db)}" if db else ""
    pattern = re.compile(re.escape(short) + r"__\w+_[0-9a-f]{12}")
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{where} LIKE '{short}__*'").collect()]
    return [t for t in (".".join([*db, n]) for n in found if pattern.fullmatch(n)) if t.lower() not in {b.lower() for b in but}]


def drop_served(spark: SparkSession, name: str) -> None:
    """Take a served name and its version tables out of the catalog; files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for table in version_tables(spark, name, set()):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


# ------------------------------------------------------------------ the log

EVENTS = ("table string, publish_id string, kind string, published_at timestamp, base string, version string, "
          "partition_columns array<string>, schema string")
TUPLES = "table string, publish_id string, tuple map<string, string>, row_count bigint"


class PublishLog:
    """An append-only log of publishes, as Parquet under ``path`` (``events`` and ``tuples``).

    ``kind`` is publish, rollback, or failed (which takes back the entry of the same id).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException:  # nothing logged yet
            return self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    def tuples(self) -> DataFrame:
        """Partition tuples and row counts of each publish; an unpartitioned version has one empty tuple."""
        return self._read("tuples", TUPLES)

    def _append(self, name: str, publish_id: str, kind: str, base: str | None = None, version: str | None = None,
                columns: list[str] | None = None, schema: str | None = None) -> None:
        last = self.events().filter(F.col("table") == name).agg(F.max("published_at")).first()[0]
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        if last is not None:  # two entries never have the same time
            last = last.astimezone(timezone.utc).replace(tzinfo=None)
            now = max(now, last + timedelta(microseconds=1))
        row = (name, publish_id, kind, now.replace(tzinfo=timezone.utc), base, version, columns, schema)
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(f"{self.path}/events")

    def begin(self, name: str, what: Serving, kind: str, shown: StructType, columns: list[str]) -> None:
        # only partition columns are read: row counts come from the files' footers
        counted = self.spark.read.schema(shown).parquet(what.path).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
        pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
        as_map = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string, string>)")
        counted.select(F.lit(name).alias("table"), F.lit(what.publish_id).alias("publish_id"), as_map.alias("tuple"), "row_count"
                       ).write.mode("append").parquet(f"{self.path}/tuples")
        self._append(name, what.publish_id, kind, what.base, what.version, columns, shown.json())

    def failed(self, name: str, publish_id: str) -> None:
        self._append(name, publish_id, "failed")

    def settle(self, name: str, shown: Serving | None) -> None:
        """Mark the last entry failed if its switch never came."""
        last = self.history(name).orderBy(F.col("published_at").desc()).select("publish_id").first()
        if last is not None and (shown is None or last["publish_id"] != shown.publish_id):
            self.failed(name, last["publish_id"])

    def history(self, name: str) -> DataFrame:
        """What ``name`` served: one row a publish, in order, from ``published_at`` until ``served_until`` (null: still)."""
        events = self.events().filter(F.col("table") == name)
        failed = events.filter("kind = 'failed'").select("publish_id")
        done = events.filter("kind <> 'failed'").join(failed, "publish_id", "left_anti")
        order = Window.partitionBy("table").orderBy("published_at")  # a row a publish
        counts = self.tuples().groupBy("publish_id").agg(F.count(F.lit(1)).alias("partitions"), F.sum("row_count").alias("row_count"))
        return done.withColumns({"nth": F.row_number().over(order), "served_until": F.lead("published_at").over(order)}).join(
            counts, "publish_id", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))

    def as_of(self, name: str, when: datetime | Column) -> DataFrame:
        """The rows that ``name`` showed at ``when``, read from that version's files with the schema it showed."""
        at = when if isinstance(when, Column) else F.lit(when)
        row = self.history(name).filter(F.col("published_at") <= at).orderBy(F.col("published_at").desc()).first()
        if row is None:
            raise ValueError(f"{name} showed nothing at {when}")
        return self.read(row)

    def read(self, row) -> DataFrame:
        schema = StructType.fromJson(json.loads(row["schema"]))
        return self.spark.read.schema(schema).parquet(V.version_path(row["base"], row["version"]))

    def publish(self, name: str, base: str, version: str, partition_columns: Sequence[str] | None = None,
                keep_columns: bool = True) -> Serving:
        return publish(self.spark, name, base, version, partition_columns, keep_columns, self)

    def roll_back(self, name: str, steps: int = 1) -> Serving:
        """Show again what was served ``steps`` publishes before; the log has it as a rollback."""
        rows = self.history(name).orderBy(F.col("published_at").desc()).limit(steps + 1).collect()
        if len(rows) <= steps:
            raise ValueError(f"{name} has no publish {steps} before the present one")
        back = rows[steps]
        return publish(self.spark, name, back["base"], back["version"], back["partition_columns"], True, self, "rollback")
