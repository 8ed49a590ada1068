"""Delta versions: a version is the segments of the one before and a new one with the batch's new rows.

An insert-only merge never changes or removes a row, so the existing side need
not be written again: ``{base}/{version}/data`` holds only what the merge added,
and ``{base}/{version}/_manifest`` lists all segments of the version, oldest
first. The manifest is written last; without it there is no version. Segments are
as many as merges, not files; ``compact`` writes a version's rows as one.

With ``buckets``, every segment is stored in as many buckets of the merge key,
sorted by it. The buckets are the same in all segments, so a merge reads the
existing side's keys where they lie: only the batch is shuffled, to them.

A version is read, and served, through a catalog table whose partitions are the
segments (``_segment``), wherever they lie.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.operators.merge import new_rows
from keelson.session import store, unique_name
from keelson.sinks import served
from keelson.sinks import versioned as V

SEGMENT = "_segment"
_MANIFEST = "position int, path string, rows bigint, buckets int, schema string"


@dataclass(frozen=True)
class Segment:
    path: str
    rows: int


class DeltaVersions:
    """The delta versions under ``base`` of a dataset with merge key ``keys``, in ``buckets`` of it (0: none)."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], buckets: int = 0):
        self.spark, self.base, self.keys, self.buckets = spark, base.rstrip("/"), list(keys), buckets

    # -------------------------------------------------------------- what there is

    def _manifest(self, version: str) -> list:
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{V.version_path(self.base, version)}/_manifest").orderBy("position").collect()
        except AnalysisException as missing:
            raise ValueError(f"no version {version} under {self.base}") from missing
        if any(r.buckets != self.buckets for r in rows):
            raise ValueError(f"version {version} has segments of {sorted({r.buckets for r in rows})} buckets, not {self.buckets}")
        return rows

    def segments(self, version: str) -> list[Segment]:
        return [Segment(r.path, r.rows) for r in self._manifest(version)]

    def schema(self, version: str) -> StructType:
        """All segments' columns: the first one's, then those that later batches brought."""
        fields = {}
        for r in self._manifest(version):
            for f in StructType.fromJson(json.loads(r.schema)).fields:
                if fields.setdefault(f.name, f).dataType != f.dataType:
                    raise ValueError(f"segments of version {version} differ in the type of {f.name}")
        return StructType(list(fields.values()))

    # -------------------------------------------------------------- reading

    def register(self, version: str, table: str) -> StructType:
        """Make ``table`` show the version's segments; its columns without ``_segment``."""
        schema = self.schema(version)
        by = ""
        if self.buckets:
            keys = ", ".join(f"`{k}`" for k in self.keys)
            by = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
        V._ensure_database(self.spark, table)
        self.spark.sql(f"CREATE TABLE {table} ({V.ddl_columns(schema)}, `{SEGMENT}` INT) USING parquet PARTITIONED BY (`{SEGMENT}`)"
                       f"{by} LOCATION {V._sql_str(V.version_path(self.base, version))}")
        V._in_batches(self.spark, f"ALTER TABLE {table} ADD", [
            f"PARTITION (`{SEGMENT}` = {i}) LOCATION {V._sql_str(s.path)}" for i, s in enumerate(self.segments(version))], " ")
        return schema

    def table(self, version: str) -> str:
        """The name of the version's own table, which ``read`` makes."""
        return f"default.keelson_delta_{zlib.crc32(f'{self.base} {version}'.encode()):08x}"

    def read(self, version: str) -> DataFrame:
        """The version's rows. Its table stays in the catalog until ``forget``."""
        table = self.table(version)
        if not self.spark.catalog.tableExists(table):
            self.register(version, table)
        return self.spark.table(table).drop(SEGMENT)

    def forget(self, version: str) -> None:
        """Take the version's table out of the catalog; files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(version)}")

    def states(self, version: str, label: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``make``'s result for each segment of the version, in one frame.

        Each is made once and kept beside its segment under ``label``, so a
        version after a merge only reads the rows that the merge added. ``make``
        gives states that add up over disjoint rows. It gets a segment's rows
        with the version's columns of that segment's time.
        """
        out = None
        for r in self._manifest(version):
            path = f"{r.path.rsplit('/', 1)[0]}/_states_{label}"
            try:
                kept = self.spark.read.parquet(path)
            except AnalysisException:
                rows = self.spark.read.schema(StructType.fromJson(json.loads(r.schema))).parquet(r.path)
                make(rows).write.parquet(path)
                kept = self.spark.read.parquet(path)
            out = kept if out is None else out.unionByName(kept, allowMissingColumns=True)
        return out

    # -------------------------------------------------------------- writing

    def _segment(self, df: DataFrame, version: str) -> Segment:
        path = f"{V.version_path(self.base, version)}/data"
        seen = Observation(unique_name("rows"))
        data = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if not self.buckets:
            data.write.mode("overwrite").parquet(path)
            return Segment(path, int(seen.get["rows"]))
        # the name is only needed to write buckets; one task a bucket writes one file
        name = unique_name("default.keelson_segment")
        data.repartition(self.buckets, *self.keys).write.mode("overwrite").option("path", path).bucketBy(
            self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return Segment(path, int(seen.get["rows"]))

    def _commit(self, version: str, old: list, new: Segment, schema: StructType) -> None:
        rows = [(r.position, r.path, r.rows, r.buckets, r.schema) for r in old]
        rows.append((len(old), new.path, new.rows, self.buckets, schema.json()))
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{V.version_path(self.base, version)}/_manifest")

    def create(self, df: DataFrame, version: str) -> None:
        """A first version: one segment of all rows."""
        self._commit(version, [], self._segment(df, version), df.schema)

    def merge(self, old: str, new: str, updates: DataFrame) -> int:
        """Version ``new``: ``old`` and the rows of ``updates`` whose key it lacks; how many these are.

        The semantics of ``insert_only_merge``. Written is what is new; read of
        the existing side are its keys.
        """
        if old == new:
            raise ValueError(f"version {new} can't be merged into itself")
        before = self._manifest(old)
        batch = store(updates, "batch")
        table = unique_name("default.keelson_merge")
        try:
            self.register(old, table)
            fresh = self._segment(new_rows(batch.df, self.spark.table(table), self.keys), new)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            batch.drop()
        self._commit(new, before, fresh, updates.schema)
        return fresh.rows

    def compact(self, old: str, new: str) -> None:
        """Version ``new``: the rows of ``old`` as one segment."""
        if old == new:
            raise ValueError(f"version {new} can't be compacted into itself")
        table = unique_name("default.keelson_compact")
        try:
            schema = self.register(old, table)
            self._commit(new, [], self._segment(self.spark.table(table).drop(SEGMENT), new), schema)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def publish(self, name: str, version: str) -> served.Serving:
        """Show the version under the served ``name``, in one statement."""
        return served.publish_registered(self.spark, name, self.base, version, self.register)
