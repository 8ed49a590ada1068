"""Texts packed in blocks, and an exchange of key blocks between them.

Some operators must know which of very many hashed keys (shingles, byte
anchors, n-grams) occur elsewhere. One row a key would cost far more than the
key. So documents are packed into compressed blocks of about ``BLOCK_BYTES``,
each block sends its distinct keys bucket by bucket of the key space, a
bucket's keys meet in one task, and its answers go back to the blocks. A key
that stands in a third of all documents is sent at most once a block, so no
bucket grows with a hot key's documents. ``PART_BLOCKS`` neighbouring blocks
are a part; what they send to a bucket, and what it answers them, is one row.

Blocks are stored once, bucketed by ``part``, so that answers come to them
without moving the texts again. A part is what a task holds at once.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from keelson.llm.textbytes import pieces
from keelson.session import Stored, scratch_path, store, unique_name

#: Bytes of text in a block, and of text for each bucket of the key space.
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
#: Blocks of a part, and the bits of the numbers of a task's parts, a part's blocks and a block's rows.
PART_BLOCKS = 8
TASK_BITS, BLOCK_BITS, ROW_BITS = 20, 5, 14
#: zstd level of the blocks: they are stored, so size counts more than time.
LEVEL = 6


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(blob)) as r:
        return r.read_next_batch()


#: The stored frames of each call of a ``scoped`` function that is under way.
_SCOPES: list[list[DataFrame]] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    table = store(df, label)
    return _noted(table.df, table)


def _noted(df: DataFrame, table: Stored) -> DataFrame:
    df.stored_table = table
    if _SCOPES:
        _SCOPES[-1].append(df)
    return df


def drop(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        df.stored_table.drop()


def scoped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``fn`` whose result is stored, and whose other stored frames are deleted then; without any, the plain result."""
    @functools.wraps(fn)
    def run(*args, **kwargs) -> DataFrame:
        _SCOPES.append([])
        try:
            out = fn(*args, **kwargs)
            spent = [df for df in _SCOPES[-1] if df is not out]
            if spent and not hasattr(out, "stored_table"):
                out = stored(out, fn.__name__)
        finally:
            made = _SCOPES.pop()
        drop(*spent)
        if _SCOPES and hasattr(out, "stored_table"):
            _SCOPES[-1].append(out)
        return out
    return run


def stored_by_part(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in buckets of ``part``: grouping by part needs no shuffle of it.

    The table's name is only needed to write and to read it as a bucketed one;
    it is dropped at once, the files stay in the shared folder.
    """
    spark, name = df.sparkSession, unique_name("keelson_" + label)
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, label)
    df.write.option("path", path).bucketBy(buckets, "part").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return _noted(out, Stored(out, path))


def pack(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored blocks (``part``, ``batch``, ``bytes``, ``blob``) of all rows and columns of ``docs``; batch numbers are unique.

    ``PART_BLOCKS`` blocks make a part, whatever the size of an input split.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << TASK_BITS
        for i, piece in enumerate(pieces(batches, text_col, block_bytes, 1 << ROW_BITS)):
            part, nth = first + i // PART_BLOCKS, i % PART_BLOCKS
            piece = pa.RecordBatch.from_arrays(
                [pa.concat_arrays([c]) for c in piece.columns], schema=piece.schema)  # own offsets, not a view
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "batch": pa.array([(part << BLOCK_BITS) + nth], pa.int64()),
                "bytes": pa.array([piece.nbytes], pa.int64()), "blob": pa.array([pack_batch(piece)], pa.binary())})

    return stored_by_part(docs.mapInArrow(run, "part bigint, batch bigint, bytes bigint, blob binary"), "blocks")


def row_ids(number: int, rows: int) -> np.ndarray:
    """Unique ids of the rows of block ``number``, which hold the numbers of block and part too."""
    return (number << ROW_BITS) + np.arange(rows, dtype=np.int64)


def part_of(uid: str) -> Column:
    return F.shiftright(uid, ROW_BITS + BLOCK_BITS)


def block_of(uid: str) -> Column:
    return F.shiftright(uid, ROW_BITS)


def row_of(uid: str) -> Column:
    return F.col(uid).bitwiseAND((1 << ROW_BITS) - 1).cast("int")


def going_to_parts(rows: DataFrame, *columns: str):
    """``rows`` (uid, ...) by the part where their uid lies, for a cogroup; ``come`` gives the function its columns.

    They go as one new column: the rows often come from the very table they
    are sent to, and a column that both sides have may get lost on the way.
    """
    return rows.select(part_of("uid").alias("part"), F.struct(*columns).alias("row")).groupBy("part")


def come(right: pa.Table) -> pa.Table:
    return pa.Table.from_struct_array(right.column("row"))


def bucket_count(blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of the key space: by the size of all texts, 16 at least."""
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    return max(16, math.ceil(total / bucket_bytes))


def bucket_bounds(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty buckets of ascending 64-bit keys, and their bounds among them."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at = np.flatnonzero(np.diff(bucket)) + 1
    first = np.concatenate([[0], at])
    return bucket[first].astype(np.int64), np.concatenate([first, [len(h)]])


def packed_keys(h: np.ndarray) -> bytes:
    """Ascending 64-bit keys, byte by byte; their upper bytes hardly change and are compressed."""
    planes = h.astype("<u8").view(np.uint8).reshape(-1, 8).T
    upper = pa.compress(np.ascontiguousarray(planes[5:]).tobytes(), "zstd", asbytes=True) if len(h) else b""
    return np.array([len(h), len(upper)], np.int64).tobytes() + upper + np.ascontiguousarray(planes[:5]).tobytes()


def unpacked_keys(b: bytes) -> tuple[np.ndarray, int]:
    """The keys, and where what follows them begins."""
    n, size = np.frombuffer(b, np.int64, 2).tolist()
    out = np.zeros((n, 8), np.uint8)
    end = 16 + size + 5 * n
    if n:
        out[:, 5:] = np.frombuffer(pa.decompress(b[16 : 16 + size], 3 * n, "zstd", asbytes=True), np.uint8).reshape(3, n).T
        out[:, :5] = np.frombuffer(b, np.uint8, 5 * n, 16 + size).reshape(5, n).T
    return out.reshape(-1).view("<u8"), end


Send = Callable[..., tuple[np.ndarray, Callable[[int, int], bytes]]]
Answer = Callable[[list[bytes]], list[bytes | None]]
Each = Callable[..., Iterator[pa.RecordBatch]]


def framed(numbers: list[int], values: list[bytes]) -> bytes:
    """The values of several blocks as one."""
    return np.array([len(numbers), *numbers, *map(len, values)], np.int64).tobytes() + b"".join(values)


def unframed(frame: bytes) -> tuple[list[int], list[bytes]]:
    n = int(np.frombuffer(frame, np.int64, 1)[0])
    ends = 8 + 16 * n + np.cumsum(np.frombuffer(frame, np.int64, n, 8 + 8 * n))
    starts = np.concatenate([[8 + 16 * n], ends[:-1]])
    return np.frombuffer(frame, np.int64, n, 8).tolist(), [frame[x:y] for x, y in zip(starts.tolist(), ends.tolist())]


class _Frames:
    """Payloads of a part's blocks, bucket by bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.bytes = buckets, {}, 0

    def add(self, number: int, h: np.ndarray, payload: Callable[[int, int], bytes]) -> None:
        which, bounds = bucket_bounds(h, self.buckets)
        for bucket, x, y in zip(which.tolist(), bounds.tolist(), bounds[1:].tolist()):
            value = payload(x, y)
            numbers, values = self.held.setdefault(bucket, ([], []))
            numbers.append(number)
            values.append(value)
            self.bytes += len(value)

    def rows(self, part: int) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({
            "bucket": pa.array(list(self.held), pa.int32()), "part": pa.array([part] * len(self.held), pa.int64()),
            "payload": pa.array([framed(*x) for x in self.held.values()], pa.binary())})
        self.held, self.bytes = {}, 0
        return out


def exchange(blocks: DataFrame, buckets: int, send: Send, answer: Answer, replies: DataFrame | None = None) -> DataFrame:
    """(``part``, ``bucket``, ``reply``): what each bucket answers to the blocks of each part.

    ``send(rows)``, or ``send(rows, replies)`` with earlier replies, gives a
    block's keys in ascending order and a function that makes the payload of
    keys [lo, hi). ``answer(payloads)`` gets all payloads of a bucket and gives
    a reply, or None for none, to each.
    """
    schema = "bucket int, part bigint, payload binary"

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, at = _Frames(buckets), None
        for b in batches:
            for part, number, blob in zip(b.column("part").to_pylist(), b.column("batch").to_pylist(), b.column("blob")):
                if frames.held and (part != at or frames.bytes > PART_BLOCKS * BLOCK_BYTES * 4):
                    yield frames.rows(at)
                at = part
                frames.add(number, *send(unpack_batch(blob.as_py())))
        if frames.held:
            yield frames.rows(at)

    def sent_on(left: pa.Table, right: pa.Table) -> pa.Table:
        got, frames = _by_block(right), _Frames(buckets)
        for number, blob in zip(left.column("batch").to_pylist(), left.column("blob")):
            frames.add(number, *send(unpack_batch(blob.as_py()), got.pop(number, {})))
        return pa.Table.from_batches([frames.rows(left.column("part")[0].as_py() if left.num_rows else -1)])

    def answered(group: pa.Table) -> pa.Table:
        frames = [unframed(x) for x in group.column("payload").to_pylist()]
        found = iter(answer([v for _, values in frames for v in values]))
        out = []
        for numbers, values in frames:
            some = [(n, r) for n, r in zip(numbers, [next(found) for _ in values]) if r is not None]
            out.append(framed(*map(list, zip(*some))) if some else None)
        pa.default_memory_pool().release_unused()  # a worker lives on: give back what this bucket took
        keep = pa.array([r is not None for r in out], pa.bool_())
        return group.select(["part", "bucket"]).append_column("reply", pa.array(out, pa.binary())).filter(keep)

    rows = (blocks.select("part", "batch", "blob").mapInArrow(sent, schema) if replies is None else
            blocks.select("part", "batch", "blob").groupBy("part").cogroup(_from_part(replies)).applyInArrow(sent_on, schema))
    return rows.groupBy("bucket").applyInArrow(answered, "part bigint, bucket int, reply binary")


def _from_part(replies: DataFrame):
    """Replies by part; the key stands first, or the function might not get all columns."""
    return replies.select("part", "bucket", "reply").groupBy("part")


def _by_block(replies: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    if replies.num_rows:
        for bucket, frame in zip(replies.column("bucket").to_pylist(), replies.column("reply").to_pylist()):
            for number, reply in zip(*unframed(frame)):
                out.setdefault(number, {})[bucket] = reply
    return out


def with_replies(blocks: DataFrame, replies: DataFrame, each: Each, schema: str | StructType) -> DataFrame:
    """``each(part, batch, rows, replies by bucket, other columns)`` on every block; it yields record batches of ``schema``."""
    target = to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = _by_block(right)
        out = []
        for i in range(left.num_rows):
            block = {c: left.column(c)[i].as_py() for c in left.column_names}
            out += each(block["part"], block["batch"], unpack_batch(block.pop("blob")), got.pop(block["batch"], {}), block)
        pa.default_memory_pool().release_unused()
        return pa.concat_tables([pa.Table.from_batches([x]).select(target.names).cast(target) for x in out]
                                or [target.empty_table()])

    return blocks.groupBy("part").cogroup(_from_part(replies)).applyInArrow(run, schema)


def shared_keys(blocks: DataFrame, buckets: int, keys: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Replies that mark the keys of each block that occur in two documents or more.

    ``keys(rows)``: a block's distinct keys in ascending order, and whether
    each stands in several of the block's documents.
    """
    def send(rows: pa.RecordBatch):
        h, several = keys(rows)

        def payload(lo: int, hi: int) -> bytes:
            return packed_keys(h[lo:hi]) + np.packbits(several[lo:hi]).tobytes()
        return h, payload

    def answer(payloads: list[bytes]) -> list[bytes | None]:
        keys = [unpacked_keys(p) for p in payloads]
        counts, h = [len(k) for k, _ in keys], np.concatenate([k for k, _ in keys])
        several = np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8, offset=end), count=len(k))
                                  for p, (k, end) in zip(payloads, keys)]).astype(bool)
        ordered = np.sort(h)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
            several |= twice[at] == h
        cuts = np.cumsum(counts)[:-1]
        return [np.packbits(x).tobytes() if x.any() else None for x in np.split(several, cuts)]

    return exchange(blocks, buckets, send, answer)


def shared_mask(h: np.ndarray, buckets: int, got: dict[int, bytes]) -> np.ndarray:
    """The answer of ``shared_keys`` for a block's ascending keys."""
    out = np.zeros(len(h), bool)
    if got:
        which, bounds = bucket_bounds(h, buckets)
        for b, lo, hi in zip(which.tolist(), bounds, bounds[1:]):
            if b in got:
                out[lo:hi] = np.unpackbits(np.frombuffer(got[b], np.uint8), count=int(hi - lo)).astype(bool)
    return out


def packed_counts(count: np.ndarray) -> bytes:
    return pa.compress(count.astype("<i8").tobytes(), "zstd", asbytes=True)


def unpacked_counts(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, 8 * n, "zstd", asbytes=True), "<i8") if n else np.zeros(0, np.int64)


def counted_keys(blocks: DataFrame, buckets: int, count: Callable[..., tuple[np.ndarray, np.ndarray]],
                 replies: DataFrame | None = None) -> DataFrame:
    """Replies with the corpus total of each block's keys that total two or more.

    ``count(rows[, replies])``: a block's distinct keys, ascending, and how
    often the block has each.
    """
    def send(*block):
        h, n = count(*block)

        def payload(lo: int, hi: int) -> bytes:
            return packed_keys(h[lo:hi]) + packed_counts(n[lo:hi])
        return h, payload

    def answer(payloads: list[bytes]) -> list[bytes | None]:
        keys = [unpacked_keys(p) for p in payloads]
        sizes, key = [len(k) for k, _ in keys], np.concatenate([k for k, _ in keys])
        each = np.concatenate([unpacked_counts(p[end:], len(k)) for p, (k, end) in zip(payloads, keys)])
        _, inverse = np.unique(key, return_inverse=True)
        total = np.bincount(inverse, weights=each)[inverse].astype(np.int64)
        out = []
        for t in np.split(total, np.cumsum(sizes)[:-1]):
            more = t > 1
            out.append(np.packbits(more).tobytes() + packed_counts(t[more]) if more.any() else None)
        return out

    return exchange(blocks, buckets, send, answer, replies)


def key_totals(h: np.ndarray, buckets: int, got: dict[int, bytes]) -> np.ndarray:
    """The answer of ``counted_keys`` for a block's ascending keys."""
    total = np.ones(len(h), np.int64)
    which, cuts = bucket_bounds(h, buckets)
    for b, lo, hi in zip(which.tolist(), cuts.tolist(), cuts[1:].tolist()):
        if b in got:
            width = -(-(hi - lo) // 8)
            more = np.unpackbits(np.frombuffer(got[b], np.uint8, width), count=hi - lo).astype(bool)
            total[lo:hi][more] = unpacked_counts(got[b][width:], int(more.sum()))
    return total
