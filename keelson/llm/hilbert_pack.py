"""Packing along a space-filling curve.

A document's tokens are projected (a fixed random vector a token id, summed and
scaled) to ``DIMS`` dimensions; each is cut to ``BITS`` bits by the normal
distribution function, and the cell's Hilbert index is the document's key.
Documents are range-sorted by the key, and their tokens, each document followed
by one end token, are laid out along the curve and cut every ``size`` tokens.
So neighbours on the curve share sequences, and only the very last sequence is
padded (to the next power of two if that is less than ``size``).

Only (key, number of tokens) is sorted; sums run within the range partitions,
and one total a partition is carried over. Tokens stay in packed blocks, to
which the places return.

Edge cases: a null or empty text is its end token alone. Equal keys (copies)
are ordered by block and row, and spread over range partitions like any other
rows. Rows of equal or null doc_id are packed each. Texts are encoded whole and
cut freely. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from keelson.llm.packed import BLOCK_BITS, PART_BLOCKS, TASK_BITS, pack_batch, stored, stored_by_part, unpack_batch
from keelson.llm.textbytes import pieces, ranges
from keelson.llm.tokens import STEP_BYTES, encoder

#: Dimensions of the projection and bits of each; the sequence length and the end token.
DIMS, BITS, SIZE, END_ID = 3, 16, 2048, 1


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert curve index of integer cells (rows: points, columns: dimensions), as int64."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    m = 1 << (bits - 1)
    q = m
    while q > 1:  # from the outermost cell inwards: undo its rotation
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = m
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def projection(vocabulary: int, dims: int = DIMS) -> np.ndarray:
    """A fixed random vector for each token id."""
    return np.random.default_rng(7).standard_normal((vocabulary, dims)).astype(np.float32)


def curve_keys(ids: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key of each document; without tokens, that of the origin."""
    n = np.diff(bounds)
    sums = np.zeros((len(n), vectors.shape[1]))
    full = np.flatnonzero(n)
    if len(full):
        for d in range(vectors.shape[1]):
            sums[full, d] = np.add.reduceat(vectors[:, d][ids], bounds[full], dtype=np.float64)
    z = sums / np.sqrt(np.maximum(1, n))[:, None]
    share = 1 / (1 + np.exp(-1.702 * np.clip(z / 4, -12, 12)))   # close to the normal distribution function
    return hilbert_index(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Stored blocks: packed (doc_id, ids) rows, with each row's number of tokens and curve key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_path)
        vectors = projection(len(encode.sizes))
        dtype = np.uint16 if max(len(encode.sizes) - 1, end_id) < 1 << 16 else np.uint32
        first = TaskContext.get().partitionId() << TASK_BITS
        for i, b in enumerate(pieces(batches, "text", STEP_BYTES)):
            part = first + i // PART_BLOCKS
            ids, bounds = encode(b.column("text"))
            keys = curve_keys(ids, bounds, vectors)
            n = np.diff(bounds)
            whole = np.full(len(ids) + len(n), end_id, dtype)
            whole[ranges(bounds[:-1] + np.arange(len(n)), n)] = ids
            at = (bounds + np.arange(len(bounds))).astype(np.int64) * whole.itemsize
            binary = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(whole.tobytes())])
            rows = pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "ids": binary})
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "batch": pa.array([(part << BLOCK_BITS) + i % PART_BLOCKS], pa.int64()), "width": pa.array([whole.itemsize], pa.int32()),
                "sizes": pa.array([n + 1], pa.list_(pa.int64())), "keys": pa.array([keys], pa.list_(pa.int64())),
                "blob": pa.array([pack_batch(rows)], pa.binary())})

    return stored_by_part(docs.select("doc_id", "text").mapInArrow(
        run, "part bigint, batch bigint, width int, sizes array<bigint>, keys array<bigint>, blob binary"), "tokens")


def curve_places(blocks: DataFrame) -> DataFrame:
    """(``batch``, ``places``): where each row's first token stands on the curve, in the block's row order."""
    rows = blocks.select("batch", F.posexplode(F.arrays_zip("keys", "sizes")).alias("row", "x")).select(
        "batch", "row", F.col("x.keys").alias("key"), F.col("x.sizes").alias("size"))

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            size = b.column("size").to_numpy()
            ends = total + np.cumsum(size)
            yield pa.RecordBatch.from_pydict({
                "batch": b.column("batch"), "row": b.column("row"), "size": b.column("size"),
                "part": pa.array(np.full(b.num_rows, part), pa.int32()), "before": pa.array(ends - size, pa.int64())})
            total = int(ends[-1]) if b.num_rows else total

    # stored: the part numbers must not change any more
    sorted_rows = stored(rows.repartitionByRange("key", "batch", "row").sortWithinPartitions("key", "batch", "row").mapInArrow(
        running, "batch bigint, row int, size bigint, part int, before bigint"), "curve")
    totals = sorted_rows.groupBy("part").agg(F.sum("size").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range partition
    starts = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    placed = sorted_rows.join(F.broadcast(starts), "part").select(
        "batch", "row", (F.col("start") + F.col("before")).alias("place"))
    return placed.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("row", "place"))).alias("p")).select(
        "batch", F.col("p.place").alias("places"))


PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "`offset` bigint")


def packed_pieces(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID,
                  with_ids: bool = False) -> DataFrame:
    """One row a piece of a document in a sequence; ``with_ids`` adds its ids."""
    blocks = token_blocks(docs, tokenizer_path, end_id)
    schema = PIECES + ", ids array<bigint>" * with_ids
    target = to_arrow_schema(StructType.fromDDL(schema))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        places = dict(zip(right.column("batch").to_pylist(), right.column("places"))) if right.num_rows else {}
        done = []
        for number, width, blob in zip(left.column("batch").to_pylist(), left.column("width").to_pylist(), left.column("blob")):
            rows, place = unpack_batch(blob.as_py()), places[number].values.to_numpy()
            binary = rows.column("ids")
            at = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + rows.num_rows + 1] // width
            ids = np.frombuffer(binary.buffers()[2], np.uint16 if width == 2 else np.uint32)
            n = np.diff(at)
            first = place // size
            count = (place + n - 1) // size - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            sequence = ranges(first, count)
            lo = np.maximum(sequence * size, place[doc])
            hi = np.minimum((sequence + 1) * size, (place + n)[doc])
            x, y = lo - place[doc] + at[doc], hi - place[doc] + at[doc]
            parts = [ids[p:q].astype("<u4").tobytes() for p, q in zip(x.tolist(), y.tolist())]
            out = {"doc_id": rows.column("doc_id").cast(pa.int64()).take(pa.array(doc)), "start": pa.array(lo - place[doc]),
                   "length": pa.array(hi - lo), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                   "doc_tokens": pa.array(n[doc]), "sequence_id": pa.array(sequence), "offset": pa.array(lo - sequence * size)}
            if with_ids:
                out["ids"] = pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in parts], pa.list_(pa.int64()))
            done.append(pa.RecordBatch.from_pydict(out))
        return pa.concat_tables([pa.Table.from_batches([x]).cast(target) for x in done] or [target.empty_table()])

    # the places come to the blocks, which lie by part: the ids don't move
    places = curve_places(blocks).select(F.shiftright("batch", BLOCK_BITS).alias("part"), "batch", "places")
    return blocks.select("part", "batch", "width", "blob").groupBy("part").cogroup(places.groupBy("part")).applyInArrow(cut, schema)
