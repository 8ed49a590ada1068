"""Removal of repeated byte strings by common-prefix interval trees of suffix arrays.

A byte of a document goes if it is covered by a string of ``LEAST`` (50) bytes
that also starts in a document with a smaller doc_id. Matches never cross
documents, and strings are judged on the input.

How the suffix arrays stay small and distributed, exactly:

1. Every 50-byte window owns an anchor: its k-byte gram of least hash, by the
   hash's upper half (leftmost if equal). Equal windows own equal anchors, so a window can only
   repeat where its anchor does. Documents are packed in blocks, blocks
   exchange their distinct anchor hashes, and learn which stand in other
   documents.
2. The windows of a shared anchor form a segment of 84 bytes at most. Equal
   segments of a block collapse to one with its least doc_id, and are sent to
   the anchor's bucket, so a passage in a third of all documents sends one
   segment a block. An anchor with more than ``SPLIT`` of them (a frequent
   phrase in differing contexts) is hot: its windows are sent one by one by
   their own hashes, spread over all buckets, and a bucket answers which of
   them a smaller document has.
3. A bucket builds an enhanced suffix array (sorted suffixes and common-prefix
   lengths) over its distinct segments, without the suffixes whose first 50
   bytes start no other (told by a cheap hash that may keep some more, as
   intervals of 50 bytes hold none), and scans it with a stack into
   common-prefix intervals of 50 bytes or more. Intervals whose occurrences
   differ in the byte before them are maximal repeat groups; each holds all
   its occurrences, and every occurrence in a document above the group's least
   doc_id is covered over the repeat's whole length.
4. The covered bytes go back to the blocks as bit masks.

Edge cases: a null or empty text, and one below 50 bytes, is kept whole. Rows
of equal doc_id don't remove from each other; a null doc_id counts as larger
than all others. Texts of any length are one unit of a block. An empty table
gives an empty table; extra columns are carried or ignored as ``finish`` asks.
Segments and the windows of hot anchors are collapsed by 64-bit hashes of
their bytes; anchors that collide by hash only add segments, which the suffix
array tells apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm.packed import (
    bucket_bounds, bucket_count, drop, exchange, pack, pack_batch, packed_keys, stored_by_part, unpack_batch,
    unpacked_keys, with_replies,
)
from keelson.llm.textbytes import STEP, GramHash, SpanHash, flat, mix, ranges

# Fixed value: the least length of a repeat.
LEAST = 50
#: Bytes of a gram; windows of LEAST bytes hold GRAMS of them; segments have SEGMENT bytes at most.
GRAM = 16
GRAMS = LEAST - GRAM + 1
SEGMENT = LEAST + GRAMS - 1
WIDTH = -(-SEGMENT // 8) * 8
BUCKET_BYTES = 1 << 20
#: Segments of an anchor, summed over the blocks' distinct ones, above which its windows are dealt by their own hashes.
SPLIT = 4096
#: Rows of the suffix matrix compared at once.
ROWS = 1 << 15
#: The bits of a gram's place in its block, below the upper half of its hash.
_PLACE = np.uint64((1 << 32) - 1)

Finish = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor key, text number, start, end, anchor's place from start) of every maximal run of windows with one anchor."""
    empty = np.zeros(0, np.int64)
    if len(data) < LEAST:
        return np.zeros(0, np.uint64), empty, empty, empty, empty
    sizes = np.maximum(np.diff(offsets) - LEAST + 1, 0)
    start = ranges(offsets[:-1], sizes)
    if not len(start):
        return np.zeros(0, np.uint64), empty, empty, empty, empty
    gram = GramHash(data).every(GRAM)
    owner = _owners(gram)[start]
    new = owner[1:] != owner[:-1]
    ends = np.cumsum(sizes)
    new[ends[(ends > 0) & (ends < len(start))] - 1] = True
    cut = np.flatnonzero(new) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(start)]]) - 1
    text = np.searchsorted(offsets, start[first], "right") - 1
    return _key(gram[owner[first]]), text, start[first], start[last] + LEAST, owner[first] - start[first]


def _owners(gram: np.ndarray) -> np.ndarray:
    """The place of each window's anchor among the grams."""
    out = np.empty(len(gram) - GRAMS + 1, np.int64)
    for lo in range(0, len(out), STEP):
        part = gram[lo : lo + STEP + GRAMS - 1]
        # half a hash and the place in one number: the least is the leftmost gram of least half hash
        least, width = (part & ~_PLACE) | np.arange(lo, lo + len(part), dtype=np.uint64), 1
        while width < GRAMS:
            step = min(width, GRAMS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        out[lo : lo + len(least)] = least & _PLACE
    return out


def _key(gram: np.ndarray) -> np.ndarray:
    """An anchor's key: mixed anew, since the least grams would all fall in the first buckets."""
    return mix(gram ^ np.uint64(0x5FCB8D1A2E7C4B93))


def _anchor_keys(rows: pa.RecordBatch):
    """A block's distinct anchors, whether several texts have each, and its segments with their anchor's place."""
    data, offsets = flat(rows.column("text"))
    key, text, start, end, anchor = segments(data, offsets)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(key)]])[: len(first)] - 1
    several = text[order][first] != text[order][last]
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return key[order][first], several, place, (data, offsets, text, start, end, anchor)


def _distinct(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each item's place among the distinct ``keys``, ascending, and the item of least doc at each place."""
    order = np.lexsort((doc, *keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return place, order[new]


def _segment_counts(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct anchors, whether several texts have each, and how many distinct segments each has."""
    keys, several, place, (data, _, _, start, end, _) = _anchor_keys(rows)
    count = np.bincount(place, minlength=len(keys))
    more = np.flatnonzero(count[place] > 1)
    if len(more):
        _, first = _distinct(np.zeros(len(more)), place[more], SpanHash(data)(start[more], end[more]))
        count[count > 1] = 0
        count += np.bincount(place[more][first], minlength=len(keys))
    return keys, several, count


def marked_anchors(blocks: DataFrame, buckets: int, split: int) -> DataFrame:
    """Replies that mark each block's anchors in two documents or more, and those of them with over ``split`` segments."""
    def send(rows: pa.RecordBatch):
        h, several, count = _segment_counts(rows)

        def payload(lo: int, hi: int) -> bytes:
            n = count[lo:hi]
            return (packed_keys(h[lo:hi]) + np.packbits(several[lo:hi]).tobytes()
                    + np.packbits(n > 1).tobytes() + n[n > 1].astype("<u4").tobytes())
        return h, payload

    def answer(payloads: list[bytes]) -> list[bytes | None]:
        keys, flags, counts = [], [], []
        for p in payloads:
            key, at = unpacked_keys(p)
            n, width = len(key), -(-len(key) // 8)
            keys.append(key)
            flags.append(np.unpackbits(np.frombuffer(p, np.uint8, width, at), count=n).astype(bool))
            each = np.ones(n, np.int64)
            more = np.unpackbits(np.frombuffer(p, np.uint8, width, at + width), count=n).astype(bool)
            each[more] = np.frombuffer(p, "<u4", offset=at + 2 * width)
            counts.append(each)
        _, inverse, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = np.concatenate(flags) | (times > 1)[inverse]
        hot = shared & (np.bincount(inverse, weights=np.concatenate(counts)) > split)[inverse]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return [np.packbits(x).tobytes() + (np.packbits(y).tobytes() if y.any() else b"") if x.any() else None
                for x, y in zip(np.split(shared, cuts), np.split(hot, cuts))]

    return exchange(blocks, buckets, send, answer)


def _marks(h: np.ndarray, buckets: int, got: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The answer of ``marked_anchors`` for a block's ascending anchors: shared, hot."""
    out = np.zeros((2, len(h)), bool)
    which, bounds = bucket_bounds(h, buckets)
    for b, lo, hi in zip(which.tolist(), bounds, bounds[1:]):
        if b in got:
            n = int(hi - lo)
            bits = np.unpackbits(np.frombuffer(got[b], np.uint8).reshape(-1, -(-n // 8)), axis=1, count=n)
            out[: len(bits), lo:hi] = bits
    return out[0], out[1]


class _Segments:
    """Distinct candidate segments of a block's rows, by ascending key, with their least doc_id.

    Segments of hot anchors stand as their windows instead. ``sent`` holds the keys of both, ascending.
    """

    def __init__(self, rows: pa.RecordBatch):
        self.data, self.offsets = flat(rows.column("text"))
        counts = np.diff(np.asarray(rows.column("_keelson_start").offsets))
        text = np.repeat(np.arange(rows.num_rows), counts)
        start = rows.column("_keelson_start").flatten().to_numpy() + self.offsets[text]
        end = start + rows.column("_keelson_size").flatten().to_numpy()
        anchor = start + rows.column("_keelson_anchor").flatten().to_numpy()
        hot = rows.column("_keelson_hot").flatten().to_numpy(zero_copy_only=False)
        doc = rows.column("doc_id").cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()[text]
        spans = SpanHash(self.data)
        whole = ~hot
        self.start, self.end = start[whole], end[whole]
        key = _key(GramHash(self.data).at(anchor[whole], GRAM))
        self.place, self.first = _distinct(doc[whole], key, spans(self.start, self.end))
        self.key, self.least = key[self.first], doc[whole][self.first]
        self.above = doc[whole] > self.least[self.place]

        count = (end - start)[hot] - LEAST + 1
        self.window, doc = ranges(start[hot], count), np.repeat(doc[hot], count)
        key = spans(self.window, self.window + LEAST)
        self.window_place, first = _distinct(doc, key)
        self.window_key, self.window_least = key[first], doc[first]
        self.window_above = doc > self.window_least[self.window_place]

        both = np.concatenate([self.key, self.window_key])
        order = np.argsort(both, kind="stable")
        self.sent = both[order]
        self._whole = np.concatenate([[0], np.cumsum(order < len(self.key))])

    def between(self, lo: int, hi: int) -> tuple[int, int, int, int]:
        """Bounds of the segments and of the windows among the sent keys [lo, hi)."""
        a, b = int(self._whole[lo]), int(self._whole[hi])
        return a, b, lo - a, hi - b

    def payload(self, lo: int, hi: int) -> bytes:
        a, b, c, d = self.between(lo, hi)
        one = self.first[a:b]
        size = self.end[one] - self.start[one]
        body = self.data[ranges(self.start[one], size)]
        raw = (self.least[a:b].tobytes() + self.window_key[c:d].tobytes() + self.window_least[c:d].tobytes()
               + size.astype(np.uint8).tobytes() + body.tobytes())
        return np.array([b - a, d - c, len(raw)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)

    def covered(self, buckets: int, got: dict[int, bytes]) -> np.ndarray:
        """Which bytes go, by the buckets' answers."""
        mask, gone = np.zeros((len(self.key), WIDTH), bool), np.zeros(len(self.window_key), bool)
        which, bounds = bucket_bounds(self.sent, buckets)
        for k, lo, hi in zip(which.tolist(), bounds.tolist(), bounds[1:].tolist()):
            if k in got:
                a, b, c, d = self.between(lo, hi)
                bits, width = np.frombuffer(got[k], np.uint8), WIDTH // 8
                mask[a:b] = np.unpackbits(bits[: (b - a) * width].reshape(b - a, width), axis=1)
                gone[c:d] = np.unpackbits(bits[(b - a) * width :], count=d - c)
        mask = mask[self.place]
        mask[self.above] = np.arange(WIDTH) < (self.end - self.start)[self.above][:, None]
        out = np.zeros(len(self.data), bool)
        out[(self.start[:, None] + np.arange(WIDTH))[mask]] = True
        at = self.window[gone[self.window_place] | self.window_above]
        if len(at):
            edge = np.bincount(at, minlength=len(out) + 1) - np.bincount(at + LEAST, minlength=len(out) + 1)
            out |= np.cumsum(edge[:-1]) > 0
        return out


def repeat_groups(lengths: np.ndarray, before: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal repeat groups of sorted suffixes: (first rank, last rank, length, least doc).

    ``lengths[i]``: common prefix of ranks i and i + 1; ``before``: the byte before
    each suffix, -1 at a segment's start. Stack scan over the ranks; an
    interval is open while the common prefix stays at its length. Groups of
    one doc are left out.
    """
    out: list[tuple[int, int, int, int]] = []
    near = np.flatnonzero(lengths >= LEAST)
    if not len(near):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    cuts = np.flatnonzero(np.diff(near) > 1) + 1
    firsts = near[np.concatenate([[0], cuts])]
    lasts = near[np.concatenate([cuts, [len(near)]]) - 1] + 1
    # two suffixes alone, as most are, make one interval
    two = lasts == firsts + 1
    lo, hi = firsts[two], lasts[two]
    alone = (doc[lo] != doc[hi]) & ((before[lo] < 0) | (before[lo] != before[hi]))
    lo, hi = lo[alone], hi[alone]
    pairs = np.stack([lo, hi, lengths[lo], np.minimum(doc[lo], doc[hi])], 1)
    firsts, lasts = firsts[~two], lasts[~two]
    for lo, hi in zip(firsts.tolist(), lasts.tolist()):
        docs, left = doc[lo : hi + 1].tolist(), before[lo : hi + 1].tolist()
        if min(docs) == max(docs):
            continue
        prefix = lengths[lo:hi].tolist()
        prefix.append(0)
        # open intervals: length, first rank, byte before all (-1: differs), least and greatest doc
        stack: list[list[int]] = []
        for i, n in enumerate(prefix):
            start, byte, least, most = i, left[i], docs[i], docs[i]
            while stack and stack[-1][0] > n:
                length, start, b, x, y = stack.pop()
                byte = b if b == byte else -1
                least, most = min(least, x), max(most, y)
                if byte < 0 and least < most:
                    out.append((lo + start, lo + i, length, least))
            if n:
                if stack and stack[-1][0] == n:
                    top = stack[-1]
                    top[2] = top[2] if top[2] == byte else -1
                    top[3], top[4] = min(top[3], least), max(top[4], most)
                else:
                    stack.append([n, start, byte, least, most])
    found = np.concatenate([pairs, np.array(out, np.int64).reshape(-1, 4)])
    return found[:, 0], found[:, 1], found[:, 2], found[:, 3]


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which keys stand more than once."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def covered_by_smaller(data: np.ndarray, bounds: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which bytes of distinct segments, each of one doc, lie in a repeat that a smaller doc has too."""
    size = np.diff(bounds)
    count = size - LEAST + 1
    start = ranges(bounds[:-1], count)
    seg = np.repeat(np.arange(len(size)), count)
    again = _repeated(GramHash(data).at(start, LEAST))
    start, seg = start[again], seg[again]
    rest = bounds[1:][seg] - start
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    suffix = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[start]
    suffix[np.arange(WIDTH) >= rest[:, None]] = 0
    order = np.argsort(suffix.view(f"S{WIDTH}").reshape(-1))
    start, seg, rest = start[order], seg[order], rest[order]
    common = np.minimum(rest[1:], rest[:-1])
    for i in range(0, len(common), ROWS):
        some = suffix[order[i : i + ROWS + 1]]
        differ = some[1:] != some[:-1]
        here = common[i : i + len(differ)]
        np.minimum(here, np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH), out=here)
    del suffix
    before = np.where(start > bounds[:-1][seg], data[start - 1].astype(np.int64), -1)
    first, last, length, least = repeat_groups(common, before, doc[seg])
    rank = ranges(first, last - first + 1)
    group = np.repeat(np.arange(len(first)), last - first + 1)
    above = doc[seg[rank]] > least[group]
    at, n = start[rank[above]], length[group[above]]
    edge = np.bincount(at, minlength=len(data) + 1) - np.bincount(at + n, minlength=len(data) + 1)
    return np.cumsum(edge[: len(data)]) > 0


def _answer(payloads: list[bytes]) -> list[bytes | None]:
    """For each sent segment, the bytes covered in its least document; for each sent window, whether it is covered there."""
    docs, sizes, bodies, keys, window_docs = [], [], [], [], []
    for p in payloads:
        n, m, raw = np.frombuffer(p, np.int64, 3).tolist()
        b = pa.decompress(p[24:], raw, "zstd", asbytes=True)
        docs.append(np.frombuffer(b, np.int64, n))
        keys.append(np.frombuffer(b, np.uint64, m, 8 * n))
        window_docs.append(np.frombuffer(b, np.int64, m, 8 * (n + m)))
        sizes.append(np.frombuffer(b, np.uint8, n, 8 * n + 16 * m).astype(np.int64))
        bodies.append(np.frombuffer(b[9 * n + 16 * m :], np.uint8))
    bits = _covered_bits(np.concatenate(docs), np.concatenate(sizes), np.concatenate(bodies))
    doc = np.concatenate(window_docs)
    place, first = _distinct(doc, np.concatenate(keys))
    gone = doc > doc[first][place]
    each = zip(np.split(bits, np.cumsum([len(d) for d in docs])[:-1]), np.split(gone, np.cumsum([len(k) for k in keys])[:-1]))
    return [x.tobytes() + np.packbits(y).tobytes() if x.any() or y.any() else None for x, y in each]


def _covered_bits(doc: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A row of bits for each segment: its covered bytes."""
    if not len(doc):
        return np.zeros((0, WIDTH // 8), np.uint8)
    end = np.cumsum(size)
    place, one = _distinct(doc, SpanHash(data)(end - size, end))
    bounds = np.concatenate([[0], np.cumsum(size[one])])
    covered = covered_by_smaller(data[ranges(end[one] - size[one], size[one])], bounds, doc[one])
    mask = np.zeros((len(one), WIDTH), bool)
    mask[np.repeat(np.arange(len(one)), size[one]), np.arange(bounds[-1]) - np.repeat(bounds[:-1], size[one])] = covered
    mask = mask[place]
    whole = doc > doc[one][place]  # another block has the same segment in a smaller document
    mask[whole] = np.arange(WIDTH) < size[whole][:, None]
    return np.packbits(mask, axis=1)


def without_repeats(docs: DataFrame, finish: Finish, schema: str, split: int = SPLIT) -> DataFrame:
    """``finish`` applied to all rows of ``docs`` (doc_id, text, any more) with their covered bytes.

    ``finish(rows, data, offsets, covered)`` gets a block's rows, all their
    texts' bytes in a row, and a flag for each byte; it returns ``schema``.
    ``split``: anchors of more segments are hot; it changes no result.
    """
    blocks = pack(docs)
    buckets = bucket_count(blocks, BUCKET_BYTES)

    def candidates(part: int, number: int, rows: pa.RecordBatch, got: dict[int, bytes], block: dict) -> Iterator[pa.RecordBatch]:
        """The texts that have shared anchors, with their segments; the others are finished at once."""
        keys, _, place, (_, offsets, text, start, end, anchor) = _anchor_keys(rows)
        shared, hot = _marks(keys, buckets, got)
        hit = shared[place]
        text, start, end, anchor, hot = text[hit], start[hit], end[hit], anchor[hit], hot[place][hit]
        has = np.zeros(rows.num_rows, bool)
        has[text] = True
        some, none = rows.filter(pa.array(has)), rows.filter(pa.array(~has))
        at = np.searchsorted(text, np.concatenate([np.flatnonzero(has), [rows.num_rows]])).astype(np.int32)
        for name, values, kind in (("_keelson_start", start - offsets[text], pa.int32()), ("_keelson_size", end - start, pa.uint8()),
                                   ("_keelson_anchor", anchor, pa.uint8()), ("_keelson_hot", hot, pa.bool_())):
            some = some.append_column(name, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind)))
        data, offsets = flat(none.column("text"))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "batch": pa.array([number], pa.int64()),
            "blob": pa.array([pack_batch(some)], pa.binary()),
            "done": pa.array([pack_batch(finish(none, data, offsets, np.zeros(len(data), bool)))], pa.binary())})

    marked = marked_anchors(blocks, buckets, split)
    some = stored_by_part(with_replies(blocks, marked, candidates, "part bigint, batch bigint, blob binary, done binary"),
                          "candidates")
    drop(blocks)

    def send(rows: pa.RecordBatch):
        found = _Segments(rows)
        return found.sent, found.payload

    def end(part: int, number: int, rows: pa.RecordBatch, got: dict[int, bytes], block: dict) -> Iterator[pa.RecordBatch]:
        done = unpack_batch(block["done"])
        if done.num_rows:
            yield done
        if rows.num_rows:
            s = _Segments(rows)
            yield finish(rows, s.data, s.offsets, s.covered(buckets, got))

    return with_replies(some, exchange(some, buckets, send, _answer), end, schema)


def spans(offsets: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal covered runs inside texts: start, end, and the len(offsets) bounds of each text's."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[1:-1] = covered[1:] != covered[:-1] if len(covered) else False
    first = edge[:-1] & covered if len(covered) else covered
    first = first.copy()
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] |= covered[offsets[:-1][offsets[:-1] < offsets[1:]]]
    last = np.zeros(len(covered), bool)
    last[:-1] = covered[:-1] & ~covered[1:]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] |= covered[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


DIGESTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def digests(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.RecordBatch:
    """``finish`` that gives counts and the digest of what is left."""
    _, _, at = spans(offsets, covered)
    removed = np.concatenate([[0], np.cumsum(covered)])
    sha = [hashlib.sha256(data[x:y][~covered[x:y]] if gone else data[x:y]).hexdigest()
           for x, y, gone in zip(offsets.tolist(), offsets[1:].tolist(), (removed[offsets[1:]] - removed[offsets[:-1]]).tolist())]
    return pa.RecordBatch.from_pydict({
        "doc_id": rows.column("doc_id").cast(pa.int64()), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
        "n_removed": pa.array(removed[offsets[1:]] - removed[offsets[:-1]], pa.int64()),
        "n_spans": pa.array(np.diff(at), pa.int64()), "kept_sha256": pa.array(sha, pa.string())})


def kept_texts(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.RecordBatch:
    """``finish`` that replaces ``text`` by what is left, and ``n_chars``; a code point goes only as a whole."""
    lead = (data & 0xC0) != 0x80
    point = np.cumsum(lead) - 1
    whole = np.ones(int(lead.sum()), bool)
    np.logical_and.at(whole, point, covered)
    gone = whole[point] if len(point) else covered
    texts = [bytes(data[x:y][~gone[x:y]]).decode() for x, y in zip(offsets.tolist(), offsets[1:].tolist())]
    out = {c: rows.column(c) for c in rows.schema.names if not c.startswith("_keelson_")}
    out["text"] = pa.array(texts, pa.string())
    out["n_chars"] = pa.array([len(t) for t in texts], rows.schema.field("n_chars").type)
    return pa.RecordBatch.from_pydict(out)
