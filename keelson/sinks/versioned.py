"""Versioned datasets: ``{base}/{version}/col=val/...`` Parquet trees, and
external catalog tables re-pointed from one version to another.

Every version stays on disk, so publishing an older version is a rollback.
A name made by ``sinks.served`` (``publish_table`` makes one for a new name)
changes in one statement. A plain external table is changed in place: publishing
first checks that the version is there, holds data files and fits the table.
Its new partition tuples are then added, the common ones re-pointed one by
one, where they are, and the absent ones dropped last; a reader may see old and
new partitions side by side, but none missing. If a step fails, what was
done is undone tuple by tuple and the error is raised again. Only tuples
that occur are registered, nulls included. Partition tuples (metadata, one
row each) reach the driver, never rows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Partitions in one DDL statement; the name Hive-style layouts give a null value.
_BATCH = 500
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def new_version() -> str:
    """Default version label: ``v`` + epoch milliseconds."""
    return f"v{int(time.time() * 1000)}"


def version_path(base: str, version: str) -> str:
    return f"{base.rstrip('/')}/{version}"


def check_partition_columns(df: DataFrame, columns: Sequence[str] | str | None) -> list[str]:
    """Parse and validate partition column names (comma string or list)."""
    if columns is None:
        raise ValueError("partition columns must be specified")
    cols = [c.strip() for c in columns.split(",")] if isinstance(columns, str) else [c.strip() for c in columns]
    if not cols or any(not c for c in cols):
        raise ValueError(f"blank partition column name in {columns!r}")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} are not columns of the data")
    return cols


def write_version(df: DataFrame, base: str, version: str,
                  partition_columns: Sequence[str] | str | None = None,
                  observation: Observation | None = None) -> str:
    """Write ``df`` as Parquet under ``{base}/{version}``, overwriting that
    version only; returns the path.

    With partition columns the rows are first rebalanced on them: AQE then
    sizes the write tasks, splitting a partition value that holds a large
    share of the rows over several tasks and merging small ones, so neither
    a hot value nor a long tail of tiny files comes out. Task retries are
    safe: Spark's commit protocol publishes each task's files once.
    """
    path = version_path(base, version)
    data = df.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else df
    writer_df = data
    cols: list[str] = []
    if partition_columns is not None:
        cols = check_partition_columns(df, partition_columns)
        writer_df = data.hint("rebalance", *cols)
    writer = writer_df.write.mode("overwrite").format("parquet")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)
    return path


def read_version(spark: SparkSession, base: str, version: str,
                 schema: StructType | str | None = None) -> DataFrame:
    """Read one version directly. Give ``schema`` to keep the partition
    columns' types (otherwise they are inferred from directory names)."""
    reader = spark.read.format("parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(version_path(base, version))


def partition_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Partition tuples that occur in ``df`` (nulls included)."""
    return df.select(*columns).distinct()


def partition_specs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Partition tuples with their row counts."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ensure_database(spark: SparkSession, name: str) -> None:
    parts = name.split(".")
    if len(parts) > 1:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {'.'.join(parts[:-1])}")


def ddl_columns(schema: StructType, exclude: Sequence[str] = ()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in exclude)


def create_partitioned_table(spark: SparkSession, name: str, schema: StructType,
                             partition_columns: Sequence[str], location: str) -> None:
    """External partitioned Parquet table, DDL derived from the data's schema
    (partition columns last, as Spark stores them)."""
    _ensure_database(spark, name)
    cols = list(partition_columns)
    ordered = StructType([f for f in schema.fields if f.name not in cols] + [schema[c] for c in cols])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns(ordered)}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in cols)}) LOCATION {_sql_str(location)}"
    )


def _is_external(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType.upper() == "EXTERNAL"


def _parse_partition(spec: str) -> list[tuple[str, str]]:
    out = []
    for part in spec.split("/"):
        k, v = part.split("=", 1)
        out.append((unquote(k), unquote(v)))
    return out


def _clauses(specs: Sequence[str], location: str | None = None) -> list[str]:
    out = []
    for spec in specs:
        kv = ", ".join(f"`{k}` = {_sql_value(v)}" for k, v in _parse_partition(spec))
        out.append(f"PARTITION ({kv})" + (f" LOCATION {_sql_str(f'{location}/{spec}')}" if location else ""))
    return out


def _sql_value(v: str) -> str:
    return "NULL" if v == _NULL_PARTITION else _sql_str(v)


def _in_batches(spark: SparkSession, head: str, clauses: Sequence[str], separator: str) -> None:
    for i in range(0, len(clauses), _BATCH):
        spark.sql(f"{head} {separator.join(clauses[i:i + _BATCH])}")


def _registered(spark: SparkSession, name: str) -> list[str]:
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def _moves(spark: SparkSession, name: str, specs: Sequence[str], root: str, undo: list[str]) -> None:
    """Move registered tuples to ``root`` where they stand; ``undo`` gets the statements that move them back."""
    for spec in specs:
        old = _partition_location(spark, name, spec)
        where = f"ALTER TABLE {name} {_clauses([spec])[0]} SET LOCATION"
        undo.append(f"{where} {_sql_str(old)}")
        spark.sql(f"{where} {_sql_str(f'{root}/{spec}')}")


def publish_partitioned(spark: SparkSession, name: str, base: str, version: str) -> None:
    """Point an existing served name or external partitioned table at
    ``{base}/{version}``, with exactly the partitions present there: a served
    name in one statement, a table in place.

    The version must exist, hold data files, have the table's partition
    columns, and keep the types of the columns it shares with the table. New
    columns are added to the table; columns that only the table has stay, and
    read as null, so that older versions can still be published.
    """
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist; create it before publishing")
    if served.serving(spark, name):
        served.publish(spark, name, base, version)
        return
    if not _is_external(spark, name):
        raise ValueError(f"table {name} must be external: dropping partitions of a managed table deletes files")
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    found = served.version_on_disk(spark, version_path(base, version), columns)
    path, dirs = found.path, found.partitions
    if not columns:
        raise ValueError(f"table {name} isn't partitioned: use publish_table")
    table = {f.name: f.dataType for f in spark.table(name).schema.fields}
    fresh = [f for f in found.schema.fields if f.name not in columns]
    clash = [f.name for f in fresh if f.name in table and table[f.name] != f.dataType]
    if clash:
        raise ValueError(f"version {path} changes the type of {clash}: nothing is published")
    added = [f for f in fresh if f.name not in table]
    old_location, old_specs = table_location(spark, name), _registered(spark, name)
    new, known = {_canonical(d): d for d in dirs}, {_canonical(s) for s in old_specs}
    absent = [s for s in old_specs if _canonical(s) not in new]
    undo: list[str] = []
    try:
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl_columns(StructType(added))})")
        # the version's own tuples first, then those of both, and the absent ones last
        fresh_clauses = [d for c, d in new.items() if c not in known]
        undo += [f"ALTER TABLE {name} DROP IF EXISTS {c}" for c in _clauses(fresh_clauses)]
        _in_batches(spark, f"ALTER TABLE {name} ADD IF NOT EXISTS", _clauses(fresh_clauses, path), " ")
        _moves(spark, name, [d for c, d in new.items() if c in known], path, undo)
        undo.append(f"ALTER TABLE {name} SET LOCATION {_sql_str(old_location)}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_str(path)}")
        undo += [f"ALTER TABLE {name} ADD IF NOT EXISTS {_clauses([s])[0]} LOCATION {_sql_str(_partition_location(spark, name, s))}"
                 for s in absent]
        _in_batches(spark, f"ALTER TABLE {name} DROP IF EXISTS", _clauses(absent), ", ")
        spark.sql(f"REFRESH TABLE {name}")
    except Exception:
        for statement in reversed(undo):
            spark.sql(statement)
        spark.sql(f"REFRESH TABLE {name}")
        raise


def _canonical(spec: str) -> str:
    """A partition's tuple as one string, however it is escaped."""
    return "\0".join(f"{k}={v}" for k, v in _parse_partition(spec))


def _partition_location(spark: SparkSession, name: str, spec: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name} {_clauses([spec])[0]}").filter(F.col("col_name") == "Location").collect()
    return rows[0]["data_type"].strip() if rows else ""


def publish_table(spark: SparkSession, name: str, base: str, version: str,
                  schema: StructType | None = None) -> None:
    """Show ``{base}/{version}``, which must exist, under ``name``, with the version's schema.

    A new name becomes a served one, where rows and schema change in one
    statement. An external table that is there already is re-pointed in one
    statement too if the schema stays or only gets new last columns (which come
    first, and read as null until then). Else it is created anew; should that
    fail, the old one is created again.
    """
    if not spark.catalog.tableExists(name) or served.serving(spark, name):
        served.publish(spark, name, base, version, [], keep_columns=False)
        return
    found = served.version_on_disk(spark, version_path(base, version), [])
    path, wanted = found.path, (schema or found.schema).fields
    current = spark.table(name).schema.fields
    same = [(f.name, f.dataType) for f in current] == [(f.name, f.dataType) for f in wanted[:len(current)]]
    if same and (len(wanted) == len(current) or _is_external(spark, name)):
        if len(wanted) > len(current):
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl_columns(StructType(wanted[len(current):]))})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_str(path)}")
        spark.sql(f"REFRESH TABLE {name}")
        return
    if not _is_external(spark, name):
        raise ValueError(f"table {name} must be external to change its schema safely")
    old = table_location(spark, name)
    create = f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION"
    spark.sql(f"DROP TABLE {name}")
    try:
        spark.sql(f"{create} {_sql_str(path)}")
    except Exception:
        spark.sql(f"{create} {_sql_str(old)}")
        raise


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a Parquet catalog table (creating its database first).
    With ``path`` the table is external at that location."""
    spark = df.sparkSession
    _ensure_database(spark, name)
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def create_empty_table_like(spark: SparkSession, template: DataFrame, name: str,
                            path: str | None = None) -> DataFrame:
    """Empty Parquet table with ``template``'s schema (the template is not scanned)."""
    empty = spark.createDataFrame([], template.schema)
    return save_table(empty, name, path)


def table_location(spark: SparkSession, name: str) -> str:
    """Location of a table as DESCRIBE FORMATTED reports it; of a served name, the version's path."""
    if what := served.serving(spark, name):
        return what.path
    row = (spark.sql(f"DESCRIBE FORMATTED {name}")
           .filter(F.col("col_name") == "Location").select("data_type").first())
    return row[0].strip() if row else ""


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """SHOW PARTITIONS as a DataFrame (``partition`` strings); of a served name, those of the version it shows."""
    what = served.serving(spark, name)
    return spark.sql(f"SHOW PARTITIONS {what.table if what else name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table or served name if it is there; an external table's files stay."""
    if served.serving(spark, name):
        served.drop_served(spark, name)
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables, if it is there; external tables' files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


from keelson.sinks import served  # noqa: E402  (each of the two modules needs the other's functions, not its names)
