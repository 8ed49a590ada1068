"""Declared reads that keep bad records apart instead of turning them into nulls.

Every field is read as text first. A record is bad if its line can't be split
into the declared fields, or if a field that isn't empty can't be read as its
declared type; it goes to the quarantine with its line, its file, and a reason that
names the first such field. All else is cast. So a null in the good rows was
null, or empty, in the file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keelson.session import Stored, store

_LINE, _FILE = "_keelson_line", "_keelson_file"
QUARANTINE = "record string, reason string, source_file string"


@dataclass(frozen=True)
class Quarantined:
    """``good``: the typed rows; ``bad``: (``record``, ``reason``, ``source_file``); both read the one stored ``raw``."""

    good: DataFrame
    bad: DataFrame
    raw: Stored

    def drop(self) -> None:
        self.raw.drop()


def _reason(schema: StructType, broken: Column) -> Column:
    """Why a record is bad; null if it is not."""
    reason = F.when(broken, F.lit("the line doesn't have the declared fields"))
    for f in schema.fields:
        value = F.col(_quoted(f.name))
        unread = value.isNotNull() & value.try_cast(f.dataType).isNull()
        reason = reason.when(unread, F.concat(F.lit(f"{f.name} is not {f.dataType.simpleString()}: "), value))
    return reason


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _split(raw: Stored, schema: StructType, broken: Column) -> Quarantined:
    reason = _reason(schema, broken)
    bad = raw.df.select(F.col(_LINE).alias("record"), reason.alias("reason"), F.col(_FILE).alias("source_file")).filter("reason IS NOT NULL")
    good = raw.df.filter(reason.isNull()).select(*(F.col(_quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields))
    return Quarantined(good, bad, raw)


def read_csv_checked(spark: SparkSession, path: str, ddl: str, header: bool = True,
                     options: dict[str, str] | None = None) -> Quarantined:
    """CSV files by a declared schema; bad records apart. The files are read once, as text fields, and stored."""
    schema = StructType.fromDDL(ddl)
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(_LINE, StringType())])
    opts = {"header": str(header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "enforceSchema": "true"}
    # a line of its own, for the record of a row whose fields could be split
    rows = spark.read.schema(text).options(**{**opts, **(options or {})}).csv(path)
    rows = rows.withColumn(_FILE, F.col("_metadata.file_path"))
    raw = store(rows, "raw_csv")
    broken = F.col(_LINE).isNotNull()
    delimiter = (options or {}).get("sep", ",")
    fields = F.concat_ws(delimiter, *(F.coalesce(F.col(_quoted(f.name)), F.lit("")) for f in schema.fields))
    out = _split(raw, schema, broken)
    bad = raw.df.select(F.coalesce(F.col(_LINE), fields).alias("record"), _reason(schema, broken).alias("reason"),
                        F.col(_FILE).alias("source_file")).filter("reason IS NOT NULL")
    return Quarantined(out.good, bad, raw)


def read_json_checked(spark: SparkSession, path: str, ddl: str) -> Quarantined:
    """JSON lines by a declared schema of plain fields; bad records apart, with their whole line."""
    schema = StructType.fromDDL(ddl)
    lines = spark.read.text(path).select(F.col("value").alias(_LINE), F.col("_metadata.file_path").alias(_FILE)).filter(
        F.length(F.trim(_LINE)) > 0)
    text = ", ".join(f"{_quoted(f.name)} string" for f in schema.fields)
    parsed = F.from_json(_LINE, f"{text}, `_keelson_bad` string", {"columnNameOfCorruptRecord": "_keelson_bad"})
    rows = lines.withColumn("_keelson_row", parsed).select(
        _LINE, _FILE, *(F.col(f"_keelson_row.{_quoted(f.name)}").alias(f.name) for f in schema.fields),
        F.col("_keelson_row._keelson_bad").isNotNull().alias("_keelson_broken"))
    return _split(store(rows, "raw_json"), schema, F.col("_keelson_broken"))


def write_quarantine(found: Quarantined, path: str) -> None:
    """Append the bad records to the quarantine beside the table."""
    found.bad.withColumn("seen_at", F.current_timestamp()).write.mode("append").parquet(path)
