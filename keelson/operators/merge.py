"""Schema alignment, insert-only merges and the tagged vertex/edge union."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.session import store

DATASET_TYPE = "dataset_type"
# Tags of the combined output.
VERTEX_TAG, EDGE_TAG = "vertex", "edge"
_LAYOUT_KEY = "keelson.layout"


def align_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by column name; columns missing on either side are null.
    Column order: ``left``'s, then ``right``'s extra ones."""
    return left.unionByName(right, allowMissingColumns=True)


# A batch of more rows than this is dealt by hash in ``insert_only_merge``: each task keeps the distinct keys of its
# share as a table, and the existing side needs no sort. With fewer, Spark broadcasts it or not, by its stored size.
DEALT_ROWS = 1_000_000


def new_rows(updates: DataFrame, existing: DataFrame, keys: Sequence[str], dealt: bool = False) -> DataFrame:
    """Rows of ``updates`` whose key is absent from ``existing`` (left anti).

    First the existing keys that occur in the batch (a semi join), then the
    batch minus those keys. Give a stored batch (``insert_only_merge`` does):
    its true size then lets Spark broadcast it before the existing side is
    shuffled. A batch above the threshold is a shuffled join of both. Only the
    key columns of ``existing`` are read. A null key never matches, so such a
    row counts as new. ``dealt``: both joins keep a table of distinct keys in each task, without a sort.
    """
    keys = list(keys)
    kept = (lambda df: df.hint("shuffle_hash")) if dealt else (lambda df: df)
    seen = kept(existing.select(*keys).join(kept(updates.select(*keys)), on=keys, how="left_semi"))
    return updates.join(seen, on=keys, how="left_anti")


def insert_only_merge(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing ∪ (updates not already present by ``keys``).

    The batch is stored once in the shared folder: it is computed once, and
    its size is known. So are its new rows, and the batch is deleted then; only
    the new rows stay stored, as the result reads them. The existing row wins;
    updates to known keys are discarded; duplicates inside the new batch all
    stay. Union by name, so a batch with another column order cannot shift
    values between columns. ``sinks.delta`` keeps such a result as a version
    without writing the existing side again.
    """
    batch = store(updates, "batch")
    fresh = store(new_rows(batch.df, existing, keys, batch.df.count() > DEALT_ROWS), "new_rows").df
    batch.drop()
    return align_union(existing, fresh)


def merge_vertices(vertices: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    return insert_only_merge(vertices, updates, [key])


def merge_edges(edges: DataFrame, updates: DataFrame,
                keys: Sequence[str] = ("src", "dst", "relationship")) -> DataFrame:
    return insert_only_merge(edges, updates, keys)


def combine_output(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One wide frame tagged ``dataset_type`` in {vertex, edge}.

    Each side's own column list is kept in the tag column's metadata (it
    survives Parquet round trips), so ``split_output`` can restore both
    schemas exactly.
    """
    layout = json.dumps({VERTEX_TAG: vertices.columns, EDGE_TAG: edges.columns})
    v = vertices.withColumn(DATASET_TYPE, F.lit(VERTEX_TAG))
    e = edges.withColumn(DATASET_TYPE, F.lit(EDGE_TAG))
    out = align_union(v, e)
    return out.withColumn(DATASET_TYPE, F.col(DATASET_TYPE).alias(DATASET_TYPE, metadata={_LAYOUT_KEY: layout}))


def split_output(data: DataFrame, vertex_columns: Sequence[str] | None = None,
                 edge_columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Inverse of ``combine_output``: each side gets only its own columns.

    Column lists come from the arguments, else from the tag's metadata, else
    every column except the tag (the padding then stays).
    """
    meta = data.schema[DATASET_TYPE].metadata.get(_LAYOUT_KEY)
    layout = json.loads(meta) if meta else {}
    rest = [c for c in data.columns if c != DATASET_TYPE]
    vcols = list(vertex_columns or layout.get(VERTEX_TAG) or rest)
    ecols = list(edge_columns or layout.get(EDGE_TAG) or rest)
    vertices = data.filter(F.col(DATASET_TYPE) == VERTEX_TAG).select(*vcols)
    edges = data.filter(F.col(DATASET_TYPE) == EDGE_TAG).select(*ecols)
    return vertices, edges
