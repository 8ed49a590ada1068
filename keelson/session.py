"""Session helpers: a local session for tests and the bench, and the shared
scratch folder that checkpoints and written intermediate tables go to.

On a cluster the caller's session is used as is. The shared folder is the one
the cluster names in ``spark.checkpoint.dir``; only when that is unset (local
tests) do we make a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "keelson") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off, UTC."""
    master = f"local[{cores}]"
    shuffle = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.default.parallelism", shuffle)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local data is small: let AQE keep ~one post-shuffle task per core
        # instead of coalescing everything under 1 MB into a single task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # local disk only: skip Hadoop's .crc sidecar file per data file
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KEELSON_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (or the directory already
    set on the context). Only if neither is set and the master is local (tests),
    a fresh local folder is made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if sc.applicationId not in _LOCAL_SCRATCH:
        root = sc.getCheckpointDir()
        if not root:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="keelson-")
            sc.setCheckpointDir(root)
        _LOCAL_SCRATCH[sc.applicationId] = root.rstrip("/")
    return _LOCAL_SCRATCH[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/scratch/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(label: str) -> str:
    """Catalog-safe unique table name."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Stored:
    """A frame written once to the shared folder, and its path."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the files; nothing may read the frame any more."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, label: str) -> Stored:
    """Write ``df`` as Parquet to the shared folder and read it back.

    One pass over the plan; the files survive lost executors, and readers get
    pruning, pushdown and true sizes for Spark's own join choices.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Workers that don't share the driver's module path (another folder, a
    cluster without ``--py-files``) get it as a zip through ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):
        path = os.path.join(tempfile.mkdtemp(prefix="keelson-zip-"), "keelson.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
