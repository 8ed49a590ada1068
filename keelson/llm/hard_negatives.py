"""Hard negatives by coordinate pruning in length buckets.

Rows are vectors of whole numbers with a label; a row's score is its inner
product with an anchor. An anchor's positives are its ``POSITIVES`` best other
rows of its label. For each positive the ``NEGATIVES`` best rows of other labels
are taken whose score lies in a given share of the positive's.

1. Rows are sorted by length and cut into buckets of at most ``BUCKET_ROWS``.
   A bucket is stored with its greatest length and, for each coordinate, the
   list of its rows in order of that coordinate of the unit vector.
2. Anchors stand in blocks, and each block meets each bucket in one task. For
   an anchor of length q and a bucket of greatest length l, a row can reach a
   score t only if its angle to the anchor has a cosine of t / (q l) or more.
   If that exceeds 1 the bucket is skipped. Else, for the ``FOCUS`` largest
   coordinates of the anchor, the angle bounds the row's unit coordinate to a
   range, which is a stretch of the sorted list. Rows in the stretches of all
   focus coordinates are scored exactly.
3. Buckets are met in rounds, longest rows first: those of one task, then
   ``WIDER`` times as many each round. The scores to reach come from the rounds
   before: the lowest of the wanted number of best scores. So the rounds are few,
   and none returns more than some ``WIDER`` times that number for an anchor.

The result is exact: bounds are widened by more than their rounding, scores are
whole numbers. Where the bounds leave over half of a bucket, as they do for dense
vectors whose coordinates are all small, the bucket is scored as a whole in
one matrix product; that changes the time only.

A row's copies cost nothing but their verification: a bucket returns the wanted
number of rows of an anchor at most. Edge cases: rows with a null id, label or
vector, or a null or non-finite component take no part. Missing components of
shorter vectors are 0; an empty vector scores 0 everywhere. Rows with the
anchor's id are no "other rows"; rows of equal ids otherwise stay separate, and
repeated anchors each get their results. Ties go by id. An anchor without
positives, or whose positives have no negatives in the share, has no rows. An
empty table gives an empty table; extra columns are ignored. Scores beyond 64
bits raise OverflowError rather than come out wrong.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.packed import drop, pack_batch, stored, unpack_batch

#: Positives of an anchor, negatives of a positive, least and greatest share (in hundredths) of the positive's score.
POSITIVES, NEGATIVES, SHARE = 5, 10, (30, 90)
#: Rows of a bucket (its lists hold 16-bit places), anchors of a block, coordinates of an anchor that prune.
BUCKET_ROWS, BLOCK_ANCHORS, FOCUS = 8192, 4096, 4
#: Growth of the buckets met in a round.
WIDER = 16
#: Anchors scored at once against a bucket, and the width added to every bound.
STEP, SLACK = 256, 1e-6
LOWEST = np.iinfo(np.int64).min


# ------------------------------------------------------------------ vectors, buckets, blocks

def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with 0."""
    size = np.diff(np.asarray(vectors.offsets))
    flat = vectors.flatten().to_numpy()
    wide = int(size.max(initial=0))
    if (size == wide).all():
        return flat.reshape(len(size), wide)
    out = np.zeros((len(size), wide), np.int64)
    out[np.arange(wide) < size[:, None]] = flat
    return out


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (0 stays 0) and lengths."""
    m = m.astype(np.float64)
    length = np.sqrt((m * m).sum(axis=1))
    return m / np.where(length > 0, length, 1)[:, None], length


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of a task's rows, which come longest first; rows of a bucket stand by id."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for table in _cut(batches, BUCKET_ROWS):
        rows = table.sort_by("vec_id").select(["vec_id", "label", "vector"]).combine_chunks().to_batches()[0]
        u, length = unit(matrix(rows.column("vector")))
        lists = np.argsort(u, axis=0, kind="stable").astype(np.uint16)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "longest": pa.array([length.max()], pa.float64()),
            "bucket": pa.array([pack_batch(rows)], pa.binary()),
            "lists": pa.array([pa.compress(lists.tobytes(), "zstd", asbytes=True)], pa.binary())})


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _cut(batches, BLOCK_ANCHORS):
        yield pa.RecordBatch.from_pydict({"block": pa.array([pack_batch(table.combine_chunks().to_batches()[0])], pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The same rows, in tables of ``most`` rows; the last may have fewer."""
    held: list[pa.RecordBatch] = []
    count = 0
    for b in batches:
        while b.num_rows:
            piece = b.slice(0, most - count)
            held.append(piece)
            count += piece.num_rows
            b = b.slice(piece.num_rows)
            if count == most:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Bucket:
    """A length bucket as its task holds it."""

    def __init__(self, blob: bytes, lists: bytes, longest: float):
        rows = unpack_batch(blob)
        self.id, self.label = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        self.rows, self.longest = matrix(rows.column("vector")), longest
        n, wide = self.rows.shape
        self.lists = np.frombuffer(pa.decompress(lists, 2 * n * wide, "zstd", asbytes=True) if wide else b"", np.uint16).reshape(n, wide)
        self.sorted = np.take_along_axis(unit(self.rows)[0], self.lists.astype(np.int64), axis=0)
        self.place = np.empty_like(self.lists)
        np.put_along_axis(self.place, self.lists.astype(np.int64), np.arange(n, dtype=np.uint16)[:, None], axis=0)

    def stretches(self, u: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor: its focus coordinates, and the stretch [lo, hi) of each one's list that is feasible."""
        wide = min(FOCUS, self.rows.shape[1], u.shape[1])
        focus = np.argsort(-np.abs(u), axis=1)[:, :wide]
        focus = np.where(focus < self.rows.shape[1], focus, 0)
        angle = np.arccos(np.clip(np.take_along_axis(u, focus, axis=1), -1, 1))
        wider = np.arccos(np.clip(cosine, -1, 1))[:, None]
        least, most = np.cos(np.minimum(angle + wider, np.pi)) - SLACK, np.cos(np.maximum(angle - wider, 0)) + SLACK
        lo, hi = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for c in np.unique(focus):
            at = focus == c
            lo[at] = np.searchsorted(self.sorted[:, c], least[at], "left")
            hi[at] = np.searchsorted(self.sorted[:, c], most[at], "right")
        return focus, lo, hi

    def candidates(self, u: np.ndarray, length: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """(anchors, rows to score with them); None: all rows of the bucket. Anchors that can't reach their score are left out."""
        top = length * self.longest * (1 + SLACK)
        live = (reach <= 0) | (top >= reach)
        prunes = live & (reach > 0)
        wide = live & ~prunes
        if prunes.any() and self.rows.shape[1] and u.shape[1]:
            some = np.flatnonzero(prunes)
            focus, lo, hi = self.stretches(u[some], reach[some] / top[some])
            narrow = (hi - lo).argmin(axis=1)
            few = (hi - lo)[np.arange(len(some)), narrow] * 2 <= len(self.id)
            wide[some[~few]] = True
            for k in np.flatnonzero(few):
                f = narrow[k]
                rows = self.lists[lo[k, f] : hi[k, f], focus[k, f]].astype(np.int64)
                where = self.place[rows[:, None], focus[k]]
                rows = rows[((where >= lo[k]) & (where < hi[k])).all(axis=1)]
                if len(rows):
                    yield some[k : k + 1], np.sort(rows)
        at = np.flatnonzero(wide)
        for i in range(0, len(at), STEP):
            yield at[i : i + STEP], None


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: floating point where it is exact, whole numbers beyond."""
    wide = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :wide], rows[:, :wide]
    most = max(wide, 1) * max((abs(int(x)) for x in (a.min(initial=0), a.max(initial=0))), default=0) * max(
        (abs(int(x)) for x in (b.min(initial=0), b.max(initial=0))), default=0)
    if most >= 1 << 63:
        raise OverflowError("scores of these vectors don't fit in 64 bits")
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _best(s: np.ndarray, ok: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``most`` best allowed scores of each anchor, best first; columns stand by id."""
    if s.shape[1] > 4 * most and ok.sum() > 8 * most * len(s):
        kth = np.partition(np.where(ok, s, LOWEST), s.shape[1] - most, axis=1)[:, s.shape[1] - most]
        ok = ok & (s >= kth[:, None])
    a, r = np.nonzero(ok)
    order = np.lexsort((r, -s[a, r], a))
    a, r = a[order], r[order]
    first = np.searchsorted(a, np.arange(len(s) + 1))
    keep = np.arange(len(a)) - first[a] < most
    return a[keep], r[keep]


# ------------------------------------------------------------------ the search

Search = Callable[["Bucket", pa.RecordBatch], Iterator[pa.RecordBatch]]


def _meet(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = None, None
        for b in batches:
            for i in range(b.num_rows):
                blob, lists = b.column("bucket")[i].as_py(), b.column("lists")[i].as_py()
                if blob != held:
                    held, bucket = blob, Bucket(blob, lists, b.column("longest")[i].as_py())
                yield from search(bucket, unpack_batch(b.column("block")[i].as_py()))
    return run


POSITIVE = "uid bigint, positive_id bigint, positive_score bigint"


def _positives(bucket: Bucket, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    q = matrix(anchors.column("vector"))
    u, length = unit(q)
    uid, ids, label, reach = (anchors.column(c).to_numpy() for c in ("uid", "vec_id", "label", "reach"))
    for at, rows in bucket.candidates(u, length, reach):
        rows = np.arange(len(bucket.id)) if rows is None else rows
        same = label[at][:, None] == bucket.label[rows]
        if same.any():
            s = scores(q[at], bucket.rows[rows])
            a, r = _best(s, same & (ids[at][:, None] != bucket.id[rows]) & (s >= reach[at][:, None]), POSITIVES)
            yield pa.RecordBatch.from_pydict({"uid": pa.array(uid[at][a]), "positive_id": pa.array(bucket.id[rows][r]),
                                              "positive_score": pa.array(s[a, r])})


NEGATIVE = "uid bigint, anchor_id bigint, nth int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def _negatives(bucket: Bucket, anchors: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    q = matrix(anchors.column("vector"))
    u, length = unit(q)
    uid, ids, label = (anchors.column(c).to_numpy() for c in ("uid", "vec_id", "label"))
    count = np.diff(np.asarray(anchors.column("positive_id").offsets))
    nth = np.arange(POSITIVES) < count[:, None]
    positive, score, low, high = (np.zeros(nth.shape, np.int64) for _ in range(4))
    for out, name in ((positive, "positive_id"), (score, "positive_score"), (low, "low"), (high, "high")):
        out[nth] = anchors.column(name).flatten().to_numpy()
    nth &= low <= high
    reach = np.where(nth, low, np.iinfo(np.int64).max).min(axis=1)
    for at, rows in bucket.candidates(u, length, reach):
        at = at[nth[at].any(axis=1)]
        if not len(at):
            continue
        rows = np.arange(len(bucket.id)) if rows is None else rows
        s = scores(q[at], bucket.rows[rows])
        other = label[at][:, None] != bucket.label[rows]
        for j in range(POSITIVES):
            a, r = _best(s, other & nth[at, j][:, None] & (s >= low[at, j][:, None]) & (s <= high[at, j][:, None]), NEGATIVES)
            if len(a):
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array(uid[at][a]), "anchor_id": pa.array(ids[at][a]), "nth": pa.array(np.full(len(a), j), pa.int32()),
                    "positive_id": pa.array(positive[at, j][a]), "positive_score": pa.array(score[at, j][a]),
                    "negative_id": pa.array(bucket.id[rows][r]), "negative_score": pa.array(s[a, r])})


def quantized(embedding: Column) -> Column:
    """floor(256 x) of each component, x as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(embedding: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~bad


class Mining:
    """The search over ``rows`` (vec_id, label, vector of whole numbers, anchor); ``drop()`` deletes its stored tables."""

    def __init__(self, rows: DataFrame):
        length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        self.rows = stored(rows.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
            F.col("vector").cast("array<bigint>").alias("vector"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
            .filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
            .withColumns({"length": length, "uid": F.monotonically_increasing_id()}), "vectors")
        total, anchors = self.rows.agg(F.count("*"), F.count_if("anchor")).first()
        self.blocks = max(1, math.ceil(anchors / BLOCK_ANCHORS))
        self.buckets = stored(
            self.rows.select("vec_id", "label", "vector", "length")
            .repartitionByRange(max(1, math.ceil(total / BUCKET_ROWS)), F.col("length").desc(), F.xxhash64("vec_id"))
            .sortWithinPartitions(F.col("length").desc()).drop("length")
            .mapInArrow(_bucket, "part int, longest double, bucket binary, lists binary"), "buckets")
        self.last = self.buckets.agg(F.max("part")).first()[0]
        self.anchors = self.rows.filter("anchor").select("uid", "vec_id", "label", "vector")
        self._spent: list[DataFrame] = []

    def _search(self, anchors: DataFrame, search: Search, schema: str, label: str, lo: int, hi: int) -> DataFrame:
        """``search`` of all anchors in the buckets of tasks lo to hi - 1."""
        blocks = stored(anchors.repartition(self.blocks).mapInArrow(_block, "block binary"), "anchors")
        part = F.explode(F.sequence(F.lit(lo), F.lit(hi - 1)))
        tasks = blocks.select("block", part.alias("part")).repartition(hi - lo, "part")
        buckets = self.buckets.filter(F.col("part").between(lo, hi - 1)).repartition(hi - lo, "part")
        found = stored(tasks.join(buckets, "part").mapInArrow(_meet(search), schema), label)
        drop(blocks)
        return found

    def _rounds(self, anchors: Callable[[DataFrame | None], DataFrame], search: Search, schema: str, label: str, key: list[str],
                most: int) -> DataFrame:
        """The ``most`` best of each key over all buckets: the first task's, then ``WIDER`` times as many each round.

        ``anchors`` gets the best so far and gives what each anchor still has to
        reach, so a round returns about ``WIDER * most`` rows of a key, however many buckets it takes.
        """
        best, lo, width = None, 0, 1
        while lo <= self.last:
            hi = min(lo + width, self.last + 1)
            found = self._search(anchors(best), search, schema, label, lo, hi)
            self._spent.append(found)
            if best is not None:
                found = best.drop("rank").unionByName(found)
            best = stored(_ranked(found, key, label, most), "best")
            self._spent.append(best)
            lo, width = hi, width * WIDER
        return best

    def positives(self) -> DataFrame:
        """(``uid``, ``rank``, ``positive_id``, ``positive_score``) of each anchor."""
        def anchors(found: DataFrame | None) -> DataFrame:
            if found is None:
                return self.anchors.withColumn("reach", F.lit(LOWEST))
            reach = found.filter(F.col("rank") == POSITIVES).select("uid", F.col("positive_score").alias("reach"))
            return self.anchors.join(reach, "uid", "left").withColumn("reach", F.coalesce("reach", F.lit(LOWEST)))

        return self._rounds(anchors, _positives, POSITIVE, "positive", ["uid"], POSITIVES)

    def negatives(self) -> DataFrame:
        """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``), stored."""
        if self.last is None:
            found = self.rows.sparkSession.createDataFrame([], NEGATIVE + ", rank int")
        else:
            low, high = (F.expr(f"{f}(cast(positive_score as decimal(38, 0)) * {s} / 100)").cast("long")
                         for f, s in (("ceil", SHARE[0]), ("floor", SHARE[1])))
            positive = stored(self.positives().withColumns({"low": low, "high": high, "nth": F.col("rank") - 1}), "positives")

            def anchors(found: DataFrame | None) -> DataFrame:
                each = positive
                if found is not None:
                    tenth = found.filter(F.col("rank") == NEGATIVES).select("uid", "nth", F.col("negative_score").alias("tenth"))
                    each = each.join(tenth, ["uid", "nth"], "left").withColumn("low", F.coalesce("tenth", "low"))
                fields = ["positive_id", "positive_score", "low", "high"]
                each = each.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("nth", *fields))).alias("x")).select(
                    "uid", *(F.col(f"x.{c}").alias(c) for c in fields))
                return self.anchors.join(each, "uid")

            found = self._rounds(anchors, _negatives, NEGATIVE, "negative", ["uid", "nth"], NEGATIVES)
            self._spent.append(positive)
        out = stored(found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "mined")
        return out

    def drop(self) -> None:
        drop(self.rows, self.buckets, *self._spent)


def _ranked(found: DataFrame, key: list[str], what: str, most: int) -> DataFrame:
    """The best of what all buckets returned; each returned ``most`` for a key at most."""
    order = Window.partitionBy(*key).orderBy(F.col(f"{what}_score").desc(), f"{what}_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(rows: DataFrame) -> DataFrame:
    """Mined (anchor, positive, negative) rows of ``rows`` (vec_id, label, vector, anchor)."""
    work = Mining(rows)
    out = work.negatives()
    work.drop()
    return out
