"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines; a long line is cut after sentences, and a
sentence every ``LONGEST`` bytes. The n-th equal paragraph of a text counts as
an element of its own, so a text is a set of 64-bit digests. Its sketch has
cells (count, sum of digests, sum of checks), each digest in three of them.
Two versions' sketches subtract cell by cell; peeling pure cells recovers the
digests that only one version has. If cells remain, both are sketched anew,
four times larger, until peeling succeeds (so the recovery is exact).

A returned fingerprint has cells by its text's number of paragraphs, three a
paragraph or more, and says how many. Fingerprints of two sizes are folded to
the smaller one (``print_differences``) and hold some three quarters as many
differences as that has cells; it says so if they don't (the tiniest may not).

Likeness of two texts: shared / all paragraphs (1 if neither has any).

``with_edits`` compares each document with an edited text of its own and with
the next document by id. Documents are dealt by ranges of ids, each packed
block once; a range learns the first document of the following range, so
nothing is sorted in one task.

Edge cases: a null text is empty, has no paragraphs, and an empty sketch. Rows
of equal id follow each other in the order of their texts (and stand in one
range, so ids should be nearly unique); a null id comes first. After the last row comes the first; a single row is its own next one. An
empty table gives an empty table; extra columns are ignored. Equal texts have
equal fingerprints; a hash of the whole text tells different ones apart.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.packed import pack_batch, unpack_batch
from keelson.llm.textbytes import SpanHash, flat, mix, pieces, ranges

#: Cells of the smallest sketch (three tables), growth on failure, bytes of a paragraph, bytes of text handled at once.
CELLS, GROWTH, LONGEST, STEP_BYTES = 12, 4, 200, 2 << 20
#: Cells of a returned fingerprint for each paragraph, at least.
PRINT_CELLS = 3
#: Cells of fingerprints made at once (a larger one stands alone).
PRINT_STEP = 1 << 18
#: Sizes tried with one table layout before the seed changes as well.
SIZES = 12


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of all texts' paragraphs, their bounds, and each whole text's hash."""
    data, offsets = flat(texts)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data):
        cut[1:] |= data == 10
        stop = (data[:-1] == 46) | (data[:-1] == 33) | (data[:-1] == 63)
        cut[2:] |= stop & (data[1:] == 32)
    edge = np.flatnonzero(cut)
    size = np.diff(edge)
    count = -(-size // LONGEST)
    start = np.repeat(edge[:-1], count) + LONGEST * ranges(np.zeros(len(count), np.int64), count)
    end = np.minimum(start + LONGEST, np.repeat(edge[1:], count))
    # line ends don't count, and a paragraph of nothing else is none
    end = end - (data[end - 1] == 10) if len(data) else end
    start, end = start[end > start], end[end > start]
    spans = SpanHash(data)
    h = spans(start, end)
    doc = np.searchsorted(offsets, start, "right") - 1
    order = np.lexsort((h, doc))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    first = np.flatnonzero(new)
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    h = mix(h + turn.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
    return h, np.searchsorted(start, offsets), spans(offsets[:-1], offsets[1:])


def _check(h: np.ndarray) -> np.ndarray:
    return mix(h ^ np.uint64(0xBF58476D1CE4E5B9))


def _places(h: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """The three cells of each digest, one in each third of the sketch."""
    third = cells // 3
    return np.stack([(mix(h + np.uint64((3 * seed + j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(third)).astype(np.int64)
                     + j * third for j in range(3)])


def sketches(h: np.ndarray, bounds: np.ndarray, cells: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, digest sums, check sums), each rows: texts, columns: cells."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds)) * cells
    at = (row + _places(h, cells, seed)).reshape(-1)
    count = np.bincount(at, minlength=n * cells)
    sums, checks = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    np.add.at(sums, at, np.tile(h, 3))
    np.add.at(checks, at, np.tile(_check(h), 3))
    return count.reshape(n, cells), sums.reshape(n, cells), checks.reshape(n, cells)


def peel(count: np.ndarray, sums: np.ndarray, checks: np.ndarray, seed: int = 0, bits: int = 64):
    """Recovered (row, digest, sign) of subtracted sketches, and which rows came out whole; ``bits`` of the checks count."""
    low = np.uint64((1 << bits) - 1)
    n, cells = count.shape
    count, sums, checks = count.reshape(-1).copy(), sums.reshape(-1).copy(), checks.reshape(-1).copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.flatnonzero(np.abs(count) == 1)
    while len(live):
        sign = count[live]
        key = np.where(sign > 0, sums[live], np.uint64(0) - sums[live])
        ok = (np.abs(sign) == 1) & (np.where(sign > 0, checks[live], np.uint64(0) - checks[live]) & low == _check(key) & low)
        live, sign, key = live[ok], sign[ok], key[ok]
        if not len(live):
            break
        row = live // cells
        order = np.lexsort((key, row))
        new = np.ones(len(order), bool)
        new[1:] = (row[order][1:] != row[order][:-1]) | (key[order][1:] != key[order][:-1])
        one = order[new]
        row, sign, key = row[one], sign[one], key[one]
        found.append((row, key, sign))
        at = (row * cells + _places(key, cells, seed)).reshape(-1)
        np.add.at(count, at, np.tile(-sign, 3))
        away = np.where(sign > 0, np.uint64(0) - key, key)
        check = _check(key)
        np.add.at(sums, at, np.tile(away, 3))
        np.add.at(checks, at, np.tile(np.where(sign > 0, np.uint64(0) - check, check), 3))
        at = np.unique(at)
        live = at[np.abs(count[at]) == 1]
    rest = ((count != 0) | (sums != 0) | (checks & low != 0)).reshape(n, cells).any(axis=1)
    row, key, sign = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, t)
                      for i, t in enumerate((np.int64, np.uint64, np.int64)))
    return row, key, sign, ~rest


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
    """(row, digest, sign) of all digests that only text a[i] (+1) or only b[i] (-1) has."""
    (ha, ba), (hb, bb) = a, b
    todo = np.arange(len(ba) - 1)
    out = []
    cells, tries = CELLS, 0
    while len(todo):
        seed = tries // SIZES
        left = sketches(ha[ranges(ba[todo], np.diff(ba)[todo])], np.append(0, np.cumsum(np.diff(ba)[todo])), cells, seed)
        right = sketches(hb[ranges(bb[todo], np.diff(bb)[todo])], np.append(0, np.cumsum(np.diff(bb)[todo])), cells, seed)
        row, key, sign, whole = peel(*(x - y for x, y in zip(left, right)), seed)
        keep = whole[row]
        out.append((todo[row[keep]], key[keep], sign[keep]))
        todo = todo[~whole]
        tries += 1
        # larger; once far above what any two such texts need, with other places
        need = 6 * int((np.diff(ba)[todo] + np.diff(bb)[todo]).max()) if len(todo) else 0
        cells = cells * GROWTH if cells < need or tries % SIZES else cells
    return tuple(np.concatenate([o[i] for o in out] or [np.zeros(0, t)]) for i, t in enumerate((np.int64, np.uint64, np.int64)))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Shared / all paragraphs of each text pair, from the recovered differences."""
    n = np.diff(a[1]) + np.diff(b[1])
    apart = np.bincount(differences(a, b)[0], minlength=len(n))
    return np.where(n + apart > 0, (n - apart) / np.maximum(1, n + apart), 1.0)


def fingerprints(h: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> list[str]:
    """Sketches sized by the texts, as text: base64 of number of paragraphs, text hash, number of cells, and cells."""
    n = np.diff(bounds)
    sizes = CELLS * GROWTH ** np.arange(20)
    cells = sizes[np.searchsorted(sizes, PRINT_CELLS * n)]
    out = [""] * len(n)
    for c in np.unique(cells).tolist():
        some = np.flatnonzero(cells == c)
        # a bounded number of cells at once
        for at in np.split(some, np.arange(1, len(some) * c // PRINT_STEP + 1) * max(1, PRINT_STEP // c)):
            for i, text in zip(at.tolist(), _prints(h[ranges(bounds[at], n[at])], np.append(0, np.cumsum(n[at])), whole[at], c)):
                out[i] = text
    return out


def _prints(h: np.ndarray, bounds: np.ndarray, whole: np.ndarray, cells: int) -> Iterator[str]:
    count, sums, checks = sketches(h, bounds, cells)
    n = len(whole)
    raw = np.zeros((n, 16 + 14 * cells), np.uint8)
    raw[:, :4] = np.diff(bounds).astype("<u4").view(np.uint8).reshape(n, 4)
    raw[:, 4:12] = whole.astype("<u8").view(np.uint8).reshape(n, 8)
    raw[:, 12:16] = np.full(n, cells, "<u4").view(np.uint8).reshape(n, 4)
    cell = raw[:, 16:].reshape(n, cells, 14)
    cell[:, :, :2] = count.astype("<u2").view(np.uint8).reshape(n, cells, 2)
    cell[:, :, 2:10] = np.ascontiguousarray(sums).astype("<u8").view(np.uint8).reshape(n, cells, 8)
    cell[:, :, 10:] = np.ascontiguousarray(checks).astype("<u8").view(np.uint8).reshape(n, cells, 8)[:, :, :4]
    return (base64.b64encode(x.tobytes()).decode() for x in raw)


def _folded(text: str, cells: int) -> list[np.ndarray]:
    """A fingerprint's counts, digest sums and check sums, folded to fewer cells."""
    raw = np.frombuffer(base64.b64decode(text), np.uint8)
    cell = raw[16:].reshape(-1, 14)
    found = (np.ascontiguousarray(cell[:, x:y]).view(kind).reshape(-1).astype(np.uint64)
             for x, y, kind in ((0, 2, "<u2"), (2, 10, "<u8"), (10, 14, "<u4")))
    return [x.reshape(3, -1, cells // 3).sum(axis=1, dtype=np.uint64).reshape(1, -1) for x in found]


def print_differences(a: str, b: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(digest, sign) of the paragraphs that only a's text (+1) or only b's (-1) has; None if the prints don't hold as many."""
    cells = min(int(np.frombuffer(base64.b64decode(x), "<u4", 1, 12)[0]) for x in (a, b))
    count, sums, checks = (x - y for x, y in zip(_folded(a, cells), _folded(b, cells)))
    _, key, sign, whole = peel(count.astype(np.uint16).astype(np.int16).astype(np.int64), sums, checks, bits=32)
    return (key, sign) if whole[0] else None


def edited_text(text: str, after: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the text after."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Result rows of all texts but the last, which only comes after."""
    edited = [edited_text(t, u) for t, u in zip(texts, texts[1:])]
    h, bounds, whole = paragraphs(pa.array(texts, pa.large_string()))
    mine, after = (h[: bounds[-2]], bounds[:-1]), (h[bounds[1] :], bounds[1:] - bounds[1])
    e = paragraphs(pa.array(edited, pa.large_string()))
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        "fingerprint": pa.array(fingerprints(*mine, whole[:-1])), "edited_fingerprint": pa.array(fingerprints(*e)),
        "near_edited": pa.array(likeness(mine, e[:2])), "near_next": pa.array(likeness(mine, after))})


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and the likeness to it and to the next document (``RESULT``)."""
    spark = docs.sparkSession
    lowest = np.iinfo(np.int64).min
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("doc_id"), "text",
                       F.col("doc_id").isNull().alias("no_id"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a bounded number of range ends, and the first id of each range: both at most ``parts`` numbers
    ends = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    ends = np.unique(np.array(ends, np.float64).astype(np.int64)) if ends else np.zeros(0, np.int64)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.sort(b.column("doc_id").to_numpy())
            part = np.searchsorted(ends, ids, "right")
            found, first = np.unique(part, return_index=True)
            yield pa.RecordBatch.from_pydict({"part": pa.array(found, pa.int32()), "first": pa.array(ids[first], pa.int64())})

    firsts = sorted(tuple(r) for r in docs.select("doc_id").mapInArrow(least, "part int, first bigint")
                    .groupBy("part").agg(F.min("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}   # which range the first row follows
    starts, follows = np.array(sorted(before), np.int64), [before[k] for k in sorted(before)]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", STEP_BYTES):
            ids = b.column("doc_id").to_numpy()
            part = np.searchsorted(ends, ids, "right")
            found = []
            for p in np.unique(part):
                found.append((int(p), False, b.filter(pa.array(part == p))))
            for i in np.flatnonzero(np.isin(ids, starts)):
                found.append((follows[int(np.searchsorted(starts, ids[i]))], True, b.slice(i, 1)))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([p for p, _, _ in found], pa.int32()), "after": pa.array([a for _, a, _ in found]),
                "blob": pa.array([pack_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in x.columns], schema=x.schema))
                                  for _, _, x in found], pa.binary())})

    def compared(group: pa.Table) -> pa.Table:
        def rows(after: bool) -> list[tuple[int, str, bool]]:
            blobs = group.filter(pc.equal(group.column("after"), after)).column("blob")
            return sorted((i, t or "", z) for x in blobs for b in [unpack_batch(x.as_py())]
                          for i, t, z in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "no_id"))))

        own = rows(False)
        texts = [t for _, t, _ in own] + [rows(True)[0][1]]
        out, at, size = [], 0, np.cumsum([0] + [len(t) for t in texts])
        while at < len(own):
            to = min(len(own), max(at + 1, int(np.searchsorted(size, size[at] + STEP_BYTES, "right")) - 1))
            out.append(_compared([None if z else i for i, _, z in own[at:to]], texts[at : to + 1]))
            at = to
        return pa.Table.from_batches(out)

    return docs.mapInArrow(dealt, "part int, after boolean, blob binary").groupBy("part").applyInArrow(compared, RESULT)
