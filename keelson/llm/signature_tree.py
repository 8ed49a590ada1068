"""N-gram Jaccard join by signature trees.

A document's set is its distinct 5-word shingles; two documents link when
100 * |intersection| >= 80 * |union|. The result is each document's component
of the link graph.

1. Exact elimination. In hash order, two linked sets share the smallest
   ``m`` elements of their intersection within a prefix of each (prefix
   filter with overlap m). Blocks exchange prefix shingles; a document with
   too few prefix shingles that occur in any other document links with none.
   The documents left exchange all their shingles: one with less than 0.8 of
   them in other documents links with none.
2. Equal sets are one class, kept by one representative.
3. Signature trees over classes that share a smallest shingle (two hash
   orders): leaves hold token bitmaps and sizes, inner nodes their OR and the
   size range. A dual traversal prunes node pairs whose greatest possible
   overlap is below the least overlap a link needs; leaf pairs that remain and
   aren't yet connected are compared exactly. This finds nearly all links.
   Buckets above ``TREE_LEAVES`` are dealt into several trees here.
4. The rest, exactly: with shingles in order of their total (rarest first),
   linked classes share one within the first n - ceil(0.8 n) + 1 of each. Such
   shingles that still join classes of different groups each get a tree (over
   all their classes, in pairs of blocks) on bitmaps and on what is left from
   the shingle on: a pair's first common shingle has its whole intersection
   behind it. Surviving pairs are compared by their whole sets.
5. Links are contracted to components.

Edge cases: fewer words than five make one shingle of them all; a null, empty
or blank text has no shingles and links with nothing (``component_id`` is its
own id). Rows of equal doc_id stay separate rows; a component's id is the
least non-null doc_id of its rows (null if all are null). An empty table gives
an empty table; extra columns are ignored. Shingles are compared by 64-bit
hashes of their bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from keelson.llm.links import linked_groups
from keelson.llm.packed import (
    bucket_count, come, counted_keys, drop, going_to_parts, key_totals, pack, part_of, row_ids, shared_keys, shared_mask,
    stored, stored_by_part, unpack_batch, with_replies,
)
from keelson.llm.textbytes import SpanHash, flat, lower_ascii, mix, ranges, words

# The link's definition.
SHINGLE_WORDS = 5
SHARE = (4, 5)          # least Jaccard similarity: 80 / 100

#: Leaves of one tree in step 3, classes of one block in step 4, children of a node, bits of a bitmap in step 4.
TREE_LEAVES, BLOCK_CLASSES, FANOUT, BITS = 256, 4096, 8, 4096


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets: ascending hashes text by text, and the bounds of each text's."""
    data, offsets = flat(texts)
    data = lower_ascii(data)
    start, end, bounds = words(data, offsets)
    w = SpanHash(data)(start, end)
    n_words = np.diff(bounds)
    n = np.where(n_words >= SHINGLE_WORDS, n_words - SHINGLE_WORDS + 1, np.minimum(n_words, 1))
    first = ranges(bounds[:-1], n)
    doc = np.repeat(np.arange(len(n)), n)
    size = np.minimum(SHINGLE_WORDS, n_words)[doc]
    h = np.zeros(len(first), np.uint64)
    padded = np.concatenate([w, np.zeros(SHINGLE_WORDS, np.uint64)])
    for k in range(SHINGLE_WORDS):
        h = h * np.uint64(0x9FB21C651E98DF25) + np.where(k < size, padded[first + k], np.uint64(0x5851F42D4C957F2D))
    h = mix(h)
    ends = np.cumsum(n)
    for lo, hi in zip((ends - n).tolist(), ends.tolist()):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def least_inside(n: np.ndarray) -> np.ndarray:
    """Least intersection with a linked set, for a set of n: ceil(0.8 n)."""
    return -(-SHARE[0] * n // SHARE[1])


def prefix_sizes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix length of a set of n, and how many of it a linked set's prefix must share at least."""
    m = np.maximum(1, n // 10)
    least = np.minimum(m, np.maximum(1, least_inside(n) // 10))
    return np.minimum(n, n - least_inside(n) + m), least


def prefix_keys(texts: pa.Array):
    """Distinct prefix shingles of a block, whether several documents have each, and their places."""
    h, bounds = shingle_sets(texts)
    n = np.diff(bounds)
    length, least = prefix_sizes(n)
    at = ranges(bounds[:-1], length)
    # mixed anew: the least hashes of each text would all fall in the first buckets
    keys, inverse, count = np.unique(_spread(h[at]), return_inverse=True, return_counts=True)
    return keys, count > 1, inverse, length, least, h, bounds


class Tree:
    """Leaves in order of (group, size), joined FANOUT at a time up to one root; levels[0] are the leaves.

    ``limit``: the most elements that a leaf may share, at most its size.
    """

    def __init__(self, size: np.ndarray, limit: np.ndarray, bits: np.ndarray, group: np.ndarray, largest: int):
        self.order = np.lexsort((size, group == largest))
        size, limit, bits, group = (x[self.order] for x in (size, limit, bits, group))
        extra = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(size, size, limit, bits, extra, group, group)]
        while len(self.levels[-1][0]) > 1:
            low, high, most, b, x, g, k = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(most, at),
                                np.bitwise_or.reduceat(b, at, axis=0), np.maximum.reduceat(x, at),
                                np.minimum.reduceat(g, at), np.maximum.reduceat(k, at)))

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether any leaf below node a may link with one of another group below node b."""
        low, high, limit, bits, extra, g, k = self.levels[level]
        both = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(limit[a], limit[b]), both + np.minimum(extra[a], extra[b]))
        if level == 0:  # an element whose bit the other side lacks is not in it
            pa_, pb = (np.bitwise_count(bits[x]).sum(axis=1, dtype=np.int64) for x in (a, b))
            most = np.minimum(most, np.minimum(low[a] - (pa_ - both), low[b] - (pb - both)))
        need = -(-SHARE[0] * (low[a] + low[b]) // (SHARE[0] + SHARE[1]))
        sizes = (SHARE[1] * high[a] >= SHARE[0] * low[b]) & (SHARE[1] * high[b] >= SHARE[0] * low[a])
        same = (g[a] == k[a]) & (g[b] == k[b]) & (g[a] == g[b])
        return (most >= need) & sizes & ~same

    def pairs(self, chunk: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaf pairs (places in the input) that the dual traversal can't rule out."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > chunk:
                stack += [(level, a[i : i + chunk], b[i : i + chunk]) for i in range(0, len(a), chunk)]
                continue
            ok = self.may_link(level, a, b)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b]
                continue
            n = len(self.levels[level - 1][0])
            x = (a[:, None] * FANOUT + np.arange(FANOUT))[:, :, None]
            y = (b[:, None] * FANOUT + np.arange(FANOUT))[:, None, :]
            x, y = np.broadcast_arrays(x, y)
            ok = (x < n) & (y < n) & np.where((a == b)[:, None, None], x < y if level == 1 else x <= y, True)
            stack.append((level - 1, x[ok], y[ok]))


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One bitmap a set: bit = a second hash of the element."""
    out = np.zeros((len(sets), bits // 64), np.uint64)
    n = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), n)
    at = mix(np.concatenate([*sets, np.zeros(0, np.uint64)]) ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(bits - 1)
    np.bitwise_or.at(out, (row, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return out


def is_link(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test on two ascending sets."""
    both = np.concatenate([a, b])
    both.sort()
    inside = int((both[1:] == both[:-1]).sum())
    return SHARE[1] * inside >= SHARE[0] * (len(a) + len(b) - inside)


def _tree_links(group: pa.Table) -> pa.Table:
    """Links that connect the classes of one tree: a forest, not all pairs."""
    uid = group.column("uid").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group.column("tokens").to_pylist()]
    size = np.array([len(s) for s in sets], np.int64)
    bits = 1 << int(np.clip(int(2 * size.max() - 1).bit_length(), 8, 14))
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in Tree(size, size, bitmaps(sets, bits), np.arange(len(sets)), -1).pairs():
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = find(x), find(y)
            if rx != ry and is_link(sets[x], sets[y]):
                root[rx] = ry
                out.append((uid[x], uid[y]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _tree_candidates(group: pa.Table) -> pa.Table:
    """Pairs of different groups that share a prefix shingle and that bitmaps and sizes can't rule out."""
    uid, size, left, cut, side = (group.column(c).to_numpy() for c in ("uid", "n", "left", "group", "block"))
    bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint64).reshape(len(uid), -1)
    values, counts = np.unique(cut, return_counts=True)
    tree = Tree(size, left, bits, cut, values[counts.argmax()])
    one = group.column("lo")[0].as_py() == group.column("hi")[0].as_py()
    found = [np.zeros((2, 0), np.int64)]
    for a, b in tree.pairs():
        across = np.ones(len(a), bool) if one else side[a] != side[b]
        found.append(np.sort(np.stack([uid[a[across]], uid[b[across]]]), axis=0))
    a, b = np.concatenate(found, axis=1)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _may_link(rows: pa.RecordBatch, buckets: int, got: dict[int, bytes]):
    """A block's sets, their bounds and digests, and which may link by their prefixes."""
    keys, _, inverse, length, least, h, bounds = prefix_keys(rows.column("text"))
    hit = shared_mask(keys, buckets, got)[inverse]
    n = np.diff(bounds)
    inside = np.concatenate([[0], np.cumsum(hit)])
    ends = np.cumsum(length)
    may = (n > 0) & (inside[ends] - inside[ends - length] >= least)
    sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(
        np.stack([mix(h ^ np.uint64(0x8EBC6AF09C88C6E3)), mix(h + np.uint64(0x589965CC75374CC3))], 1), axis=0, dtype=np.uint64)])
    return h, bounds, (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64), may


def _first_of_each(digest: np.ndarray, may: np.ndarray) -> np.ndarray:
    """The first row of each equal set among those that may link."""
    rows = np.flatnonzero(may)
    _, first = np.unique(digest[rows], axis=0, return_index=True)
    return rows[np.sort(first)]


def _spread(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0x2545F4914F6CDD1D))


def _documents(blocks: DataFrame) -> DataFrame:
    """Steps 1 and 2, stored: every row's uid, doc_id, n and set digest (d1, d2), and whether it may link.

    The first row of each equal set of a block has its tokens, and the ``prefix`` of step 4.
    """
    buckets = bucket_count(blocks)
    shared = stored(shared_keys(blocks, buckets, lambda rows: prefix_keys(rows.column("text"))[:2]), "shared")

    def whole(h: np.ndarray, bounds: np.ndarray, digest: np.ndarray, may: np.ndarray):
        one = _first_of_each(digest, may)
        at = ranges(bounds[one], np.diff(bounds)[one])
        return one, at, np.unique(_spread(h[at]), return_inverse=True, return_counts=True)

    def count(rows: pa.RecordBatch, got: dict[int, bytes]):
        keys, _, n = whole(*_may_link(rows, buckets, got))[2]
        return keys, n

    totals = stored(counted_keys(blocks, buckets, count, shared), "totals")
    replies = shared.withColumn("bucket", -1 - F.col("bucket")).unionByName(totals)

    def sets(part: int, number: int, rows: pa.RecordBatch, got: dict[int, bytes], block: dict) -> Iterator[pa.RecordBatch]:
        h, bounds, d, may = _may_link(rows, buckets, {-1 - k: v for k, v in got.items() if k < 0})
        one, at, (keys, inverse, _) = whole(h, bounds, d, may)
        total = key_totals(keys, buckets, {k: v for k, v in got.items() if k >= 0})[inverse]
        n = np.diff(bounds)
        edge = np.concatenate([[0], np.cumsum(n[one])])
        tokens, prefix, left, none = [None] * len(n), [None] * len(n), [None] * len(n), set()
        for i, lo, hi in zip(one.tolist(), edge.tolist(), edge[1:].tolist()):
            t, x = total[lo:hi], h[at[lo:hi]]
            need = int(least_inside(n[i]))
            if (t > 1).sum() < need:
                none.add((d[i, 0], d[i, 1]))
                continue
            rare = np.lexsort((x, t))[: n[i] - need + 1]
            place = np.flatnonzero(t[rare] > 1)
            tokens[i], prefix[i], left[i] = x.tobytes(), x[rare[place]].view(np.int64), n[i] - place
        if none:  # copies in this block still belong together
            copies = Counter(zip(d[may, 0], d[may, 1]))
            may = may & np.array([x not in none or copies[x] > 1 for x in zip(d[:, 0], d[:, 1])], bool)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * len(n), pa.int64()),
            "uid": pa.array(row_ids(number, len(n))), "doc_id": rows.column("doc_id"),
            "n": pa.array(n, pa.int64()), "may": pa.array(may, pa.bool_()), "d1": pa.array(d[:, 0]), "d2": pa.array(d[:, 1]),
            "tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64())), "left": pa.array(left, pa.list_(pa.int64()))})

    out = stored_by_part(with_replies(
        blocks, replies, sets, "part bigint, uid bigint, doc_id bigint, n bigint, may boolean, d1 bigint, d2 bigint, "
        "tokens binary, prefix array<bigint>, left array<bigint>"), "sets")
    drop(shared, totals)
    return out


def _tree_keys(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Two keys a class (its least elements in two hash orders), dealt into trees of TREE_LEAVES at most."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid = np.repeat(b.column("uid").to_numpy(), 2)
            found = [(int(s[0].view(np.int64)), int(mix(s ^ np.uint64(0xE7037ED1A0B428DB)).min().view(np.int64)))
                     for s in (np.frombuffer(x, np.uint64) for x in b.column("tokens").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array(uid, pa.int64()), "which": pa.array(np.tile([0, 1], len(found)), pa.int32()),
                "key": pa.array(np.array(found, np.int64).reshape(-1), pa.int64())})

    keyed = sets.select("uid", "tokens").mapInArrow(keys, "uid bigint, which int, key bigint")
    keyed = stored(keyed.join(classes.select("uid"), "uid", "left_semi"), "tree_keys")
    counts = keyed.groupBy("which", "key").agg(F.count("*").alias("c")).filter("c > 1")
    return keyed.join(counts, ["which", "key"]).select(
        "uid", "which", "key", F.pmod(F.xxhash64("uid", "which"), F.ceil(F.col("c") / TREE_LEAVES)).alias("deal"))


def _dealt_sets(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """(``which``, ``key``, ``deal``, ``uid``, ``tokens``): the sets of all tree keys.

    The sets lie in buckets of their part, and the keys come to them, so whole sets move only once, to their trees.
    """
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right, uid = come(right), left.column("uid").to_numpy()
        order = np.argsort(uid)
        at = order[np.searchsorted(uid[order], right.column("uid").to_numpy())] if right.num_rows else np.zeros(0, np.int64)
        return right.append_column("tokens", left.column("tokens").take(pa.array(at)))

    placed = going_to_parts(keys, "which", "key", "deal", "uid")
    return sets.select("part", "uid", "tokens").groupBy("part").cogroup(placed).applyInArrow(
        meet, "which int, key bigint, deal bigint, uid bigint, tokens binary")


def _crossing_links(sets: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Step 4: all links between classes of different groups, exactly.

    The whole sets aren't moved but for the pairs to compare.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x, np.uint64) for x in b.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "uid": b.column("uid"), "n": pa.array([len(x) for x in sets], pa.int64()),
                "prefix": b.column("prefix"), "left": b.column("left"), "bits": pa.array([x.tobytes() for x in bitmaps(sets, BITS)], pa.binary())})

    group = classes.select("uid").join(groups, classes.uid == groups.node, "left").select(
        "uid", F.coalesce("group", "uid").alias("group"))
    cut = stored(sets.drop("part").mapInArrow(mapped, "uid bigint, n bigint, prefix array<bigint>, left array<bigint>, bits binary")
                 .join(group, "uid"), "prefixes")
    places = cut.select("uid", "group", F.explode(F.arrays_zip("prefix", "left")).alias("x")).select(
        "uid", "group", F.col("x.prefix").alias("h"), F.col("x.left").alias("left"))
    mixed = places.groupBy("h").agg(F.min("group").alias("x"), F.max("group").alias("y"), F.count("*").alias("c")).filter("x < y")
    mixed_rows = stored(places.join(mixed.select("h", "c"), "h").select("uid", "h", "left", "c"), "mixed")
    rows = mixed_rows.join(cut.select("uid", "group", "n", "bits"), "uid").withColumn(
        "blocks", F.ceil(F.col("c") / BLOCK_CLASSES).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"lo": F.least("block", "with"), "hi": F.greatest("block", "with")})
    pairs = dealt.select("h", "lo", "hi", "block", "uid", "group", "n", "left", "bits").groupBy("h", "lo", "hi").applyInArrow(
        _tree_candidates, "a bigint, b bigint").distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            yield b.select(["a", "b"]).filter(pa.array([is_link(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64))
                                                        for p, q in zip(x, y)], pa.bool_()))

    pairs = stored(pairs, "pairs")
    drop(cut, mixed_rows)
    left = sets.select(F.col("uid").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("uid").alias("b"), F.col("tokens").alias("y"))
    out = stored(pairs.join(left, "a").join(right, "b").mapInArrow(check, "a bigint, b bigint"), "links")
    drop(pairs)
    return out


def _components(rows: DataFrame) -> DataFrame:
    """Steps 3 to 5, stored: (``d1``, ``d2``, ``g``, ``component``) of every class; g tells groups apart."""
    classes = stored(rows.filter("may").groupBy("d1", "d2").agg(
        F.min("uid").alias("uid"), F.min("doc_id").alias("least_id")), "classes")
    # a block writes an equal set's tokens with its first row, which holds the class's least uid in its block
    sets = rows.filter("tokens IS NOT NULL").select("part", "uid", "tokens", "prefix", "left")
    trees = _dealt_sets(sets, _tree_keys(sets, classes))
    links = stored(trees.groupBy("which", "key", "deal").applyInArrow(_tree_links, "a bigint, b bigint"), "links")
    groups = linked_groups(links)
    more = linked_groups(_crossing_links(sets, classes, groups).join(
        groups.select(F.col("node").alias("a"), F.col("group").alias("ga")), "a", "left").join(
        groups.select(F.col("node").alias("b"), F.col("group").alias("gb")), "b", "left").select(
        F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")))
    placed = (classes.join(groups, classes.uid == groups.node, "left")
              .select("d1", "d2", "least_id", F.coalesce("group", "uid").alias("g")))
    placed = stored(placed.join(more, placed.g == more.node, "left").select(
        "d1", "d2", "least_id", F.coalesce("group", "g").alias("g")), "placed")
    least = placed.groupBy("g").agg(F.min("least_id").alias("component"))
    return stored(placed.join(least, "g").select("d1", "d2", "g", "component"), "components")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``) of every row of ``docs`` (doc_id, text)."""
    blocks = pack(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = _documents(blocks)
    drop(blocks)
    found = _components(rows)
    alone = rows.filter("NOT may").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    linked = rows.filter("may").select("doc_id", "n", "d1", "d2").join(found, ["d1", "d2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return alone.unionByName(linked)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any more) without near duplicates.

    Of each component the row of least doc_id stays (a null id comes last;
    of equal ids, the first packed). Rows linked with nothing all stay.
    """
    blocks = pack(docs)
    rows = _documents(blocks)
    groups = rows.filter("may").select("uid", "doc_id", "d1", "d2").join(_components(rows), ["d1", "d2"]).groupBy("g").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id"), F.col("uid"))).alias("m")).select("m.uid")
    keep = rows.filter("NOT may").select("uid").unionByName(groups)
    kept_rows = keep.groupBy(part_of("uid").alias("part")).agg(F.collect_list("uid").alias("uids"))
    target = to_arrow_schema(docs.schema)

    def kept(left: pa.Table, right: pa.Table) -> pa.Table:
        uids = np.sort(right.column("uids").combine_chunks().flatten().to_numpy()) if right.num_rows else np.zeros(0, np.int64)
        out = []
        for number, blob in zip(left.column("batch").to_pylist(), left.column("blob")):
            block = unpack_batch(blob.as_py())
            first = row_ids(number, block.num_rows)
            x, y = np.searchsorted(uids, [first[0], first[-1] + 1])
            out.append(pa.Table.from_batches([block.take(pa.array(uids[x:y] - first[0]))]))
        return pa.concat_tables(out or [target.empty_table()]).select(target.names).cast(target)

    return blocks.select("part", "batch", "blob").groupBy("part").cogroup(kept_rows.groupBy("part")).applyInArrow(kept, docs.schema)
