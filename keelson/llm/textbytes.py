"""Numpy helpers for many texts at once: flat bytes, words, hashes of byte spans.

Texts of one Arrow batch are handled as one uint8 array plus offsets. The hash
of a span is a polynomial over random byte values, so equal bytes hash equally
wherever they stand; a span's hash costs O(1) after one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Two moduli lanes of the sound hash share one Mersenne prime, so reducing is a shift and an add.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_183_477_331, 2_004_318_071)
_LANES: list[list[np.ndarray]] = [[np.ones(1, np.uint32)] * 2, [np.ones(1, np.uint32)] * 2]
_LANE_VALUES = [np.random.default_rng(seed).integers(1, int(_PRIME), 256, dtype=np.uint64) for seed in (20240607, 20240608)]

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

#: Bytes hashed at once: what is made of them on the way stays in the processor's cache.
STEP = 1 << 14

#: Word separators: space, tab, \n, \v, \f, \r.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every bit of a 64-bit value over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _folded(x: np.ndarray) -> np.ndarray:
    """Smaller, and the same modulo the prime: below 2**32 where x is below 2**62."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """x below 2**63, modulo the prime."""
    x = _folded(_folded(x))
    return np.minimum(x, x - _PRIME)  # what is below the prime wraps round to more


def _grown(length: int) -> int:
    return (length | ((1 << 18) - 1)) + 1


def _lane(i: int, n: int) -> list[np.ndarray]:
    """Powers of a lane's base and of its inverse modulo the prime, at least n of each."""
    if len(_LANES[i][0]) < n:
        size = _grown(n)
        for j, base in enumerate((_BASES[i], pow(_BASES[i], -1, int(_PRIME)))):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, _reduced(p * np.uint64(pow(base, len(p), int(_PRIME))))])
            _LANES[i][j] = p[:size].astype(np.uint32)
    return _LANES[i]


class SpanHash:
    """64-bit hashes of spans [start, end) of one byte array; equal bytes have equal ones.

    Two polynomials modulo a prime, so there are no strings that collide by
    their structure, as there are modulo a power of two.
    """

    def __init__(self, data: np.ndarray):
        self.prefix = []
        for i, values in enumerate(_LANE_VALUES):
            powers = _lane(i, len(data) + 1)[0]
            sums = np.zeros(len(data) + 1, np.uint32)
            for lo in range(0, len(data), STEP):
                hi = min(lo + STEP, len(data))
                terms = _folded(values[data[lo:hi]] * powers[lo:hi])
                terms[0] += sums[lo]
                sums[lo + 1 : hi + 1] = _reduced(np.cumsum(terms))
            self.prefix.append(sums)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        lanes = []
        for i, sums in enumerate(self.prefix):
            span = sums[end].astype(np.uint64) + _PRIME - sums[start]
            lanes.append(_reduced(np.where(span >= _PRIME, span - _PRIME, span) * _lane(i, len(sums))[1][start]))
        h = (lanes[0] << np.uint64(32)) | lanes[1]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for i, b in enumerate((_BASE, inverse)):
            p = np.full(_grown(n), b, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


class GramHash:
    """Cheap hashes of all spans of a few bytes, modulo 2**64: to choose among them, not to tell spans apart."""

    def __init__(self, data: np.ndarray):
        up, _ = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        for lo in range(0, len(data), STEP):
            hi = min(lo + STEP, len(data))
            terms = _BYTE_VALUES[data[lo:hi]] * up[lo:hi]
            terms[:1] += self.prefix[lo : lo + 1]
            np.cumsum(terms, out=self.prefix[lo + 1 : hi + 1])

    def at(self, start: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the spans of k bytes from ``start``, as ``every`` has them."""
        _, down = _powers(len(self.prefix))
        return mix((self.prefix[start + k] - self.prefix[start]) * down[start])

    def every(self, k: int) -> np.ndarray:
        """Hashes of all spans of k bytes, by start."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        _, down = _powers(len(self.prefix))
        out = np.empty(n, np.uint64)
        for lo in range(0, n, STEP):
            hi = min(lo + STEP, n)
            out[lo:hi] = mix((self.prefix[lo + k : hi + k] - self.prefix[lo:hi]) * down[lo:hi])
        return out


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the len + 1 offsets. Null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    a = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lowered, every other byte kept."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the len(offsets) bounds of each text's words among them."""
    inside = ~SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = False  # a word never runs over from the text before
    start = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets[1:]] = False
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return start, end, np.searchsorted(start, offsets)


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int, max_rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of max_rows and about max_bytes of text at most (a longer text stands alone)."""
    for b in batches:
        _, offsets = flat(b.column(column))
        at = 0
        while at < b.num_rows:
            to = min(at + max_rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1))
            yield b.slice(at, to - at)
            at = to


def runs(bounds: np.ndarray) -> np.ndarray:
    """Group number of each item, for groups [bounds[i], bounds[i+1])."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] items), start[1], ... in one array."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)
