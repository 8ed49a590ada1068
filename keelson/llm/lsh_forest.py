"""MinHash near duplicates by an LSH forest.

A document's set is its distinct 5-word shingles; two documents link when
100 * |intersection| >= 85 * |union|, which is always confirmed on the full
sets. The result is each document's component of the link graph.

1. Every set gets ``HASHES`` MinHash values. Equal sets are one class, kept by
   one representative.
2. A tree of the forest is an order of these values: sorted by them, classes
   with long common prefixes stand together. A region is a prefix with its
   classes. Its depth adapts: it is ``DEPTH`` values; a region of more than
   ``REGION`` classes is cut at as many more as its size asks for, until all
   are small. At ``DEEPEST`` values large ones remain only where very many
   classes are nearly equal.
3. In a region, the longest-common-prefix neighbours whose values agree in
   ``LIKE`` places of all are candidates, nearest first; their texts are
   fetched and the full sets compared, until the region's candidates are
   connected or told apart. So a region gives a forest of links, not all pairs.
   A pair that an earlier tree has put together isn't compared again.
4. The first ``QUICK`` trees link nearly all. Their links are contracted to
   groups, and the other trees only take regions that hold several groups.
5. All links are contracted to components.

A tree puts two sets of similarity s in one region of depth d with probability
s**d, so all ``TREES`` trees miss a link of 0.85, the least there is, with
probability (1 - 0.85**d)**TREES: 2.4e-7 at the depth of 3 that regions have
where fewer than ``REGION`` classes share it. At larger depths it is 7e-6 (4)
to 6e-3 (8), but there a class has many linked neighbours, any one of which
joins it. ``LIKE`` is missed with probability 3e-8; that a pair is wrongly
taken as compared before, with 3e-6 (values are compared by half their bits).

Large regions at ``DEEPEST`` are dealt into parts: in the quick trees each part
is taken alone, in the others in pairs of parts, so nothing is left out there.

Edge cases: fewer words than five make one shingle of them all; a null, empty
or blank text has no shingles and links with nothing (``component_id`` is its
own id). Rows of equal doc_id stay separate rows; a component's id is the least
non-null doc_id of its rows (null if all are null, and then all are kept).
Texts of any length are one unit of a block. An empty table gives an empty
table; extra columns are ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.links import linked_groups
from keelson.llm.packed import (
    BLOCK_BITS, BLOCK_BYTES, PART_BLOCKS, ROW_BITS, TASK_BITS, come, drop, going_to_parts, row_ids, stored, stored_by_part,
)
from keelson.llm.signature_tree import shingle_sets
from keelson.llm.textbytes import mix, pieces

# Fixed value: the link's definition, in hundredths.
SHARE = 85

#: MinHash values of a set, trees, trees of the first round, least and greatest depth, classes of a region.
HASHES, TREES, QUICK, DEPTH, DEEPEST, REGION = 64, 16, 4, 3, 12, 256
#: Values that must agree for sets to be compared: the expected number less 6.4 standard deviations.
LIKE = 36

_RANDOM = np.random.default_rng(1206)
_FLIP = _RANDOM.integers(0, 2**64, HASHES, dtype=np.uint64)
_FACTOR = _RANDOM.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_OWN = HASHES // TREES


def tree_order(tree: int) -> np.ndarray:
    """The order of the values in a tree: first ``HASHES / TREES`` of its own, then the others, shuffled."""
    own = np.arange(tree * _OWN, (tree + 1) * _OWN)
    rest = np.setdiff1d(np.arange(HASHES), own)
    return np.concatenate([own, np.random.default_rng(tree).permutation(rest)])


_ORDER = np.stack([tree_order(t) for t in range(TREES)])


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of sets (of shingle hashes); 0 for an empty set."""
    out = np.zeros((len(bounds) - 1, HASHES), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for j in range(HASHES):
            out[some, j] = np.minimum.reduceat(((h ^ _FLIP[j]) * _FACTOR[j]) >> np.uint64(32), bounds[some])
    return out


def is_link(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on two sets of distinct elements."""
    both = np.concatenate([a, b])
    both.sort()
    inside = int((both[1:] == both[:-1]).sum())
    return 100 * inside >= SHARE * (len(both) - inside)


def _documents(docs: DataFrame) -> DataFrame:
    """Every row, stored: its uid, number of shingles, set digest (d1, d2), MinHash values and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << TASK_BITS
        for i, piece in enumerate(pieces(batches, "text", BLOCK_BYTES, 1 << ROW_BITS)):
            part = first + i // PART_BLOCKS
            h, bounds = shingle_sets(piece.column("text"))
            sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.stack(
                [mix(h ^ np.uint64(0x6C8E9CF570932BD5)), mix(h + np.uint64(0xB5026F5AA96619E9))], 1), axis=0, dtype=np.uint64)])
            digest = (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)
            n = piece.num_rows
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * n, pa.int64()), "uid": pa.array(row_ids((part << BLOCK_BITS) + i % PART_BLOCKS, n)),
                "doc_id": piece.column("doc_id"), "n": pa.array(np.diff(bounds), pa.int64()), "d1": pa.array(digest[:, 0]),
                "d2": pa.array(digest[:, 1]), "sig": pa.array([x.tobytes() for x in signatures(h, bounds)], pa.binary()),
                "text": piece.column("text")})

    return stored_by_part(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "part bigint, uid bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, sig binary, text string"), "documents")


def _values(column: pa.Array) -> np.ndarray:
    """Binary MinHash values as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), HASHES)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), HASHES)


def _taken(rows: DataFrame, wanted: DataFrame, columns: list[str], source: str, schema: str,
           made: Callable[[pa.ChunkedArray], pa.Array] = lambda x: x) -> DataFrame:
    """``wanted`` (uid and ``columns``) with what ``made`` makes of column ``source`` of their rows.

    They come to the parts where the rows lie, so nothing else of those moves.
    """
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right, uid = come(right), left.column("uid").to_numpy()
        order = np.argsort(uid)
        at = order[np.searchsorted(uid[order], right.column("uid").to_numpy())] if right.num_rows else np.zeros(0, np.int64)
        return right.append_column(source, made(left.column(source).take(pa.array(at))))

    return rows.select("part", "uid", source).groupBy("part").cogroup(going_to_parts(wanted, *columns)).applyInArrow(meet, schema)


def _low_halves(column: pa.ChunkedArray) -> pa.Array:
    """Half of each value: enough to tell which agree."""
    if not len(column):
        return pa.array([], pa.binary())
    return pa.array([x.tobytes() for x in _values(column).astype(np.uint16)], pa.binary())


def _keyed(trees: list[int] | None):
    """A key for the first ``DEPTH`` values in each of ``trees``, or for each row's own tree and depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, n = _values(b.column("sig")), b.num_rows
            tree = b.column("tree").to_numpy() if trees is None else np.repeat(trees, n)
            depth = b.column("depth").to_numpy() if trees is None else np.full(len(tree), DEPTH)
            row = np.arange(n) if trees is None else np.tile(np.arange(n), len(trees))
            key = mix((tree * 64 + depth).astype(np.uint64))
            for d in range(int(depth.max(initial=0))):
                key = np.where(d < depth, mix(key * np.uint64(0x9FB21C651E98DF25) + values[row, _ORDER[tree, d]]), key)
            yield pa.RecordBatch.from_pydict({
                "spot": pa.array((tree * 64 + depth).astype(np.int16)), "key": pa.array(key.view(np.int64)),
                "uid": b.column("uid").take(pa.array(row))})
    return run


#: ``spot``: 64 x tree + depth. ``key``: a hash of these and of the values up to the depth.
KEYED = "spot short, key bigint, uid bigint"


def _regions(rows: DataFrame, signed: DataFrame, trees: list[int], whole: bool, groups: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The regions of ``trees`` that hold several groups, stored: (``tree``, ``key``, ``lo``, ``hi``, ``uid``, ``group``),
    and the (``uid``, ``tree``) whose region of depth ``DEPTH`` is large, stored.

    Regions too large even at ``DEEPEST`` are dealt into parts, with ``whole`` into all pairs of parts.
    ``groups``: (node, group) of classes that are linked already; the others are their own.
    """
    members = stored(signed.mapInArrow(_keyed(trees), KEYED), "members")
    found, spent, large_rows = [], [], []
    while True:
        # counted first, so that only the few classes that share a region go on
        counts = stored(members.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "counts")
        shared = members.join(counts, "key")
        if groups is not None:
            linked = groups.select(F.col("node").alias("uid"), "group")
            shared = shared.join(linked, "uid", "left").withColumn("group", F.coalesce("group", "uid"))
        else:
            shared = shared.withColumn("group", F.col("uid"))
        shared = stored(shared.select("spot", "key", "uid", "group", "c"), "shared")
        drop(members, counts)
        spent.append(shared)
        sized = shared
        if groups is not None:
            several = stored(shared.groupBy("key").agg(F.min("group").alias("x"), F.max("group").alias("y")).filter("x < y").select("key"), "several")
            spent.append(several)
            sized = shared.join(several, "key")
        depth = F.col("spot").bitwiseAND(63)
        small = (F.col("c") <= REGION) | (depth >= DEEPEST)
        found.append(sized.filter(small))
        large_rows.append(sized.filter((F.col("c") > REGION) & (depth == DEPTH)).select("uid", F.shiftright("spot", 6).alias("tree")))
        if sized.filter(~small).isEmpty():
            break
        # as many values more as leave REGION of the classes, if they agree in nine of ten
        more = F.greatest(F.lit(1), F.ceil(F.log(F.col("c") / REGION) / F.log(F.lit(1 / 0.9)))).cast("int")
        deeper = sized.filter(~small).select("uid", F.shiftright("spot", 6).cast("int").alias("tree"),
                                             F.least(depth + more, F.lit(DEEPEST)).cast("int").alias("depth"))
        # they go to their values, which don't move, however often a region is cut
        valued = _taken(rows, deeper, ["uid", "tree", "depth"], "sig", "uid bigint, tree int, depth int, sig binary")
        members = stored(valued.mapInArrow(_keyed(None), KEYED), "members")
    placed = _union(found).withColumn("tree", F.shiftright("spot", 6).cast("int"))
    parts = F.ceil(F.col("c") / REGION).cast("int")
    dealt = placed.filter(F.col("c") > REGION).select(
        "tree", "key", "uid", "group", parts.alias("parts"), F.pmod(F.xxhash64("uid", "tree"), parts).cast("int").alias("part"))
    meets = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)) if whole else F.col("part")
    dealt = dealt.withColumn("with", meets).select(
        "tree", "key", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"), "uid", "group")
    plain = placed.filter(F.col("c") <= REGION).select("tree", "key", F.lit(0).alias("lo"), F.lit(0).alias("hi"), "uid", "group")
    out, large = stored(plain.unionByName(dealt), "regions"), stored(_union(large_rows).distinct(), "large")
    drop(*spent)
    return out, large


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


PLACE = ["tree", "key", "lo", "hi"]
IN_REGION = "tree int, key bigint, lo int, hi int, uid bigint, group bigint, skip int"


def _whole_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come region by region, in tables of whole regions, and the regions' bounds in each."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, last: bool) -> tuple[pa.Table, np.ndarray, pa.Table]:
        place = [table.column(c).to_numpy() for c in PLACE]
        new = np.any([p[1:] != p[:-1] for p in place], axis=0)
        bounds = np.concatenate([[0], np.flatnonzero(new) + 1])
        if last:
            return table, np.append(bounds, table.num_rows), table.slice(0, 0)
        return table.slice(0, bounds[-1]), bounds, table.slice(bounds[-1])

    for b in batches:
        if b.num_rows:
            table, bounds, rest = cut(pa.Table.from_batches([*held, b]).combine_chunks(), False)
            held = rest.to_batches()
            if table.num_rows:
                yield table, bounds
    if held:
        yield cut(pa.Table.from_batches(held).combine_chunks(), True)[:2]


class _Region:
    """The classes of one region, and which pairs of them are to be compared here."""

    def __init__(self, table: pa.Table):
        self.tree = table.column("tree")[0].as_py()
        self.group, self.skip = table.column("group").to_numpy(), table.column("skip").to_numpy()
        self.sketch = _sketches(table.column("sig").combine_chunks())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of different groups that agree in ``LIKE`` values or more, nearest first.

        A pair that an earlier tree has in a region of depth ``DEPTH`` was
        compared there; ``skip`` has a bit for each tree where a class's
        region is a larger one, cut or dealt, and so maybe without the other.
        """
        n = len(self.sketch)
        a, b = np.triu_indices(n, 1) if n > 1 else (np.zeros(0, np.int64),) * 2
        differ = self.group[a] != self.group[b]
        a, b = a[differ], b[differ]
        out = [np.zeros((3, 0), np.int64)]
        for i in range(0, len(a), 1 << 14):
            x, y = a[i : i + (1 << 14)], b[i : i + (1 << 14)]
            same = self.sketch[x] == self.sketch[y]
            agree = same.sum(axis=1)
            ok = agree >= LIKE
            x, y, same, agree = x[ok], y[ok], same[ok], agree[ok]
            before = np.zeros(len(x), bool)
            for t in range(self.tree):
                before |= same[:, _ORDER[t, :DEPTH]].all(axis=1) & ((self.skip[x] >> t) & 1 == 0)
            out.append(np.stack([x[~before], y[~before], agree[~before]]))
        a, b, agree = np.concatenate(out, axis=1)
        order = np.argsort(-agree, kind="stable")
        return a[order], b[order]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each region that are in a pair to compare."""
    for table, bounds in _whole_regions(batches):
        keep = np.zeros(table.num_rows, bool)
        for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
            if hi - lo > 1:
                a, b = _Region(table.slice(lo, hi - lo)).pairs()
                keep[lo + a] = keep[lo + b] = True
        yield from table.filter(pa.array(keep)).to_batches()


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the groups of each region: a forest, by nearest neighbours first."""
    for table, bounds in _whole_regions(batches):
        uid, out = table.column("uid").to_numpy(), []
        for lo, hi in zip(bounds.tolist(), bounds[1:].tolist()):
            out += [(uid[lo + a], uid[lo + b]) for a, b in _forest(table.slice(lo, hi - lo))]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _forest(table: pa.Table) -> list[tuple[int, int]]:
    region, (h, at) = _Region(table), shingle_sets(table.column("text"))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(*(p.tolist() for p in region.pairs())):
        rx, ry = find(int(region.group[x])), find(int(region.group[y]))
        if rx != ry and is_link(h[at[x] : at[x + 1]], h[at[y] : at[y + 1]]):
            root[rx] = ry
            out.append((x, y))
    return out


def _tree_links(rows: DataFrame, signed: DataFrame, trees: list[int], whole: bool, groups: DataFrame | None,
                earlier: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b) between classes of different groups that share a region of ``trees``, stored, and the large
    regions' (uid, tree) of these and the ``earlier`` trees."""
    regions, large = _regions(rows, signed, trees, whole, groups)
    every = large if earlier is None else stored(large.unionByName(earlier), "large")
    bits = every.groupBy("uid").agg(F.bit_or(F.expr("shiftleft(1, cast(tree AS int))")).alias("skip"))
    columns = [*PLACE, "uid", "group", "skip"]
    together = lambda df: df.repartition(*PLACE).sortWithinPartitions(*PLACE, "sig")
    marked = regions.join(stored(bits, "skip"), "uid", "left").withColumn("skip", F.coalesce("skip", F.lit(0))).select(*columns)
    sketched = _taken(rows, marked, columns, "sig", IN_REGION + ", sig binary", _low_halves)
    wanted = stored(together(sketched).mapInArrow(_candidates, IN_REGION + ", sig binary"), "wanted")
    texts = _taken(rows, wanted, [*columns, "sig"], "text", IN_REGION + ", sig binary, text string")
    out = stored(together(texts).mapInArrow(_links, "a bigint, b bigint").distinct(), "links")
    drop(regions, wanted)
    return out, every


def forest_components(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``, ``kept``) of every row of ``docs`` (doc_id, text)."""
    rows = _documents(docs)
    classes = stored(rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("uid").alias("uid"), F.min("doc_id").alias("least")), "classes")
    signed = stored(_taken(rows, classes, ["uid"], "sig", "uid bigint, sig binary"), "signed")
    first, large = _tree_links(rows, signed, list(range(QUICK)), False, None, None)
    groups = linked_groups(first)
    second, _ = _tree_links(rows, signed, list(range(QUICK, TREES)), True, groups, large)
    more = linked_groups(_between(second, groups))  # few: the groups that later trees have linked
    placed = _grouped(_grouped(classes, groups, "uid"), more, "group")
    placed = stored(placed.select("d1", "d2", "least", "group"), "placed")
    component = placed.groupBy("group").agg(F.min("least").alias("component_id"))
    of_class = stored(placed.select("d1", "d2", "group").join(component, "group").select("d1", "d2", "component_id"), "components")
    alone = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    with_component = rows.filter("n > 0").select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"]).select("doc_id", "n", "component_id")
    return alone.unionByName(with_component).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(rows: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``group``: that of the node in ``column``, or the node itself."""
    found = groups.select(F.col("node").alias(column), F.col("group").alias("found"))
    return rows.join(found, column, "left").withColumn("group", F.coalesce("found", column)).drop("found")


def _between(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Links between nodes as links between their groups."""
    ends = _grouped(links, groups, "a").withColumnRenamed("group", "x")
    return _grouped(ends, groups, "b").select(F.col("x").alias("a"), F.col("group").alias("b"))
