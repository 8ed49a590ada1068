"""Vehicle telemetry job: clean, publish a partitioned version, report
data-quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from keelson.operators.quality import vehicle_metrics
from keelson.operators.vehicle import clean_vehicle_events
from keelson.sinks.versioned import (
    check_partition_columns,
    create_partitioned_table,
    new_version,
    publish_partitioned,
    read_version,
    version_path,
    write_version,
)
from keelson.sinks.served import create_served
from keelson.sources.tables import scan_source_table

# Property defaults of the reference job.
DEFAULT_SOURCE = "vehicle_datalake.events"
DEFAULT_TARGET = "vehicle_datalake.processed_events"


class VehicleJob:
    """Properties: source-table, target-table, base-path, version,
    partition-columns (required), time-zone (default: session zone),
    create-target=true to create a missing target table from the schema
    (served: as a served name, which later publishes switch in one statement)."""

    def logic(self, spark: SparkSession, props: dict[str, str]) -> DataFrame:
        source = props.get("source-table", DEFAULT_SOURCE)
        return clean_vehicle_events(scan_source_table(spark, source), props.get("time-zone"))

    def output(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> dict[str, int]:
        target = props.get("target-table", DEFAULT_TARGET)
        if "base-path" not in props:
            raise ValueError("base-path must be specified")
        base = props["base-path"]
        if not props.get("version"):
            props["version"] = new_version()  # run_job hands metrics() the same dict
        version = props["version"]
        cols = check_partition_columns(df, props.get("partition-columns"))
        create = props.get("create-target", "false").lower()
        if create in ("true", "served") and not spark.catalog.tableExists(target):
            if create == "served":
                create_served(spark, target, df.schema, cols)
            else:
                create_partitioned_table(spark, target, df.schema, cols, version_path(base, version))
        obs = Observation("vehicle_output")
        write_version(df, base, version, cols, observation=obs)
        publish_partitioned(spark, target, base, version)
        return {"processed": int(obs.get["rows"])}

    def metrics(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> DataFrame:
        """Metrics of the result; after ``output`` they read the version just
        written instead of cleaning the source again."""
        if props.get("base-path") and props.get("version"):
            df = read_version(spark, props["base-path"], props["version"], df.schema)
        return vehicle_metrics(df)
