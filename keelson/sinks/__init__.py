"""Versioned Parquet datasets and the catalog tables that point at them."""

from keelson.sinks.versioned import (
    create_empty_table_like,
    create_partitioned_table,
    drop_database,
    drop_table,
    list_partitions,
    new_version,
    partition_specs,
    partition_values,
    publish_partitioned,
    publish_table,
    read_version,
    save_table,
    table_location,
    version_path,
    write_version,
)

__all__ = [
    "create_empty_table_like",
    "create_partitioned_table",
    "drop_database",
    "drop_table",
    "list_partitions",
    "new_version",
    "partition_specs",
    "partition_values",
    "publish_partitioned",
    "publish_table",
    "read_version",
    "save_table",
    "table_location",
    "version_path",
    "write_version",
]
