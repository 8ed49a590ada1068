"""Scans: catalog table by name, SQL text, files by format, declared CSV."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table (or view) by qualified name."""
    return spark.table(name)


def scan_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Run SQL text; named parameters are bound, never spliced into the text."""
    return spark.sql(query, args=args) if args else spark.sql(query)


def scan_source_table(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM <name>`` with the name bound as an identifier."""
    return spark.sql("SELECT * FROM IDENTIFIER(:source)", args={"source": name})


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and return it."""
    df.createOrReplaceTempView(name)
    return df


def read_files(spark: SparkSession, path: str, fmt: str = "json",
               options: dict[str, str] | None = None,
               schema: StructType | str | None = None) -> DataFrame:
    """Files by format and options. JSON defaults to one record per line."""
    opts = {"multiline": "false"} if fmt == "json" and options is None else dict(options or {})
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv_declared(spark: SparkSession, path: str, ddl: str, header: bool = True,
                      options: dict[str, str] | None = None) -> DataFrame:
    """CSV with a declared schema (no inference pass); a malformed value
    reads as null (PERMISSIVE), as in a CSV catalog table."""
    opts = {"header": str(header).lower(), "mode": "PERMISSIVE"}
    opts.update(options or {})
    return spark.read.schema(ddl).options(**opts).csv(path)


def create_csv_table(spark: SparkSession, name: str, ddl: str, path: str,
                     header: bool = True) -> DataFrame:
    """External CSV catalog table with a declared schema."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING csv "
        f"OPTIONS (path '{_quote(path)}', header '{str(header).lower()}')"
    )
    return spark.table(name)


def _quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")
