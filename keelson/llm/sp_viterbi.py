"""SentencePiece encoding and decoding in numpy batches.

Distinct words (a run of spaces and what follows) are grouped by their number
of characters, and the words of a group advance together: hashes of their
substrings are probed in the sorted hashes of the pieces.

* Unigram models: Viterbi. At each character the vectorised maximum over all
  pieces ending there gives the best score, and its start is the backpointer.
* BPE models: a best-sum path is not what such a model means (it merges in
  order of rank), so with the same batches and probes, each step takes the
  vectorised maximum over all neighbouring pairs and merges it, leftmost first.

Characters without a piece become byte pieces (or the unknown piece). The model
must have the identity normalizer with a dummy prefix and keep white space; its
path is a parameter, and the piece table is read through the library.

Edge cases: a null or empty text has no ids. A literal U+2581 is a space to
the model, so it is decoded as one. Words above ``LONG`` characters advance
alone by a heap (BPE) or in groups as others do (Viterbi). Ties take the
leftmost pair (BPE), the longest last piece (Viterbi). Repeated rows are
encoded each. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from keelson.llm.textbytes import SpanHash, flat, pieces, ranges
from keelson.llm.tokens import UnitEncoder

#: Characters of a word above which BPE merges run by a heap; bytes of text handled at once; words in a group.
LONG, STEP_BYTES, GROUP = 64, 2 << 20, 1 << 14
# Fixed value: what an unknown character costs below the least piece score (unigram).
UNKNOWN_PENALTY = 10.0
_META = "▁"


class SentencePieces(UnitEncoder):
    """Encoder and decoder of one model file. ``kind``: "bpe" or "unigram"."""

    def __init__(self, path: str, kind: str = "bpe"):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        if kind not in ("bpe", "unigram"):
            raise ValueError(f"unknown kind of model: {kind}")
        self.kind = kind
        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        is_byte = [sp.is_byte(i) for i in range(n)]
        normal = np.array([i for i in range(n) if not special[i] and not is_byte[i]])
        self.byte_ids = np.full(256, -1, np.int64)
        text = [b""] * n
        for i in range(n):
            if is_byte[i]:
                value = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], text[i] = i, bytes([value])
            elif not special[i]:
                text[i] = sp.id_to_piece(i).replace(_META, " ").encode()
        text[self.unknown] = " ⁇ ".encode()
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.ends = np.cumsum([len(t) for t in text])
        self.sizes = np.diff(self.ends, prepend=0)
        end = self.ends[normal]
        key = SpanHash(self.bytes)(end - self.sizes[normal], end)
        order = np.argsort(key)
        self.keys, self.piece = key[order], normal[order]
        self.scores = np.array([sp.get_score(int(i)) for i in self.piece])
        self.longest = max(len(t.decode(errors="replace")) for t in text)
        self.least = self.scores.min() if len(self.scores) else 0.0

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = data == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        real = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[real] = True
        start = np.flatnonzero(cut)
        ends = np.concatenate([start[1:], [len(data)]])[: len(start)]
        return start, ends, np.searchsorted(start, offsets)

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the sorted piece table, and whether the hash is there."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h

    def _pair_scores(self, spans: SpanHash, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        at, there = self.probe(spans(start, end))
        return np.where(there, self.scores[at], -np.inf)

    def _merged(self, spans: SpanHash, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BPE of words with equally many characters: edges (rows: words) left, and their number."""
        rows, last = np.arange(len(edge)), np.full(len(edge), edge.shape[1] - 1)
        out, kept = edge.copy(), last.copy()
        score = self._pair_scores(spans, edge[:, :-2], edge[:, 2:]) if edge.shape[1] > 2 else np.zeros((len(edge), 0))
        while score.shape[1]:
            best = score.argmax(axis=1)
            going = score[np.arange(len(score)), best] > -np.inf
            stop = rows[~going]
            out[stop, : edge.shape[1]], kept[stop] = edge[~going], edge.shape[1] - 1
            rows, edge, score, best = rows[going], edge[going], score[going], best[going]
            if not len(rows):
                return out, kept
            column = np.arange(edge.shape[1] - 1)
            edge = np.take_along_axis(edge, column + (column >= best[:, None] + 1), axis=1)
            column = np.arange(score.shape[1] - 1)
            score = np.take_along_axis(score, column + (column >= best[:, None]), axis=1)
            if not score.shape[1]:
                break
            line = np.arange(len(rows))
            for place in (best - 1, best):
                ok = (place >= 0) & (place < score.shape[1])
                r, c = line[ok], place[ok]
                score[r, c] = self._pair_scores(spans, edge[r, c], edge[r, c + 2])
        out[rows, : edge.shape[1]], kept[rows] = edge, edge.shape[1] - 1
        return out, kept

    def _merged_long(self, spans: SpanHash, edge: np.ndarray) -> np.ndarray:
        """BPE of one long word by a heap of pairs; the edges left."""
        n = len(edge) - 1
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def pair(i: np.ndarray, j: np.ndarray) -> list[float]:
            return self._pair_scores(spans, edge[i], edge[j]).tolist()

        first = pair(np.arange(n - 1), np.arange(2, n + 1))
        heap = [(-s, i, i + 1, i + 2) for i, s in enumerate(first) if s > -np.inf]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and after[i] == j and after[j] == k):
                continue
            alive[j], after[i] = False, k
            if k < n:
                before[k] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    y = after[x]
                    s = pair(np.array([x]), np.array([after[y]]))[0]
                    if s > -np.inf:
                        heapq.heappush(heap, (-s, x, y, after[y]))
        return np.append(edge[:-1][np.array(alive)], edge[-1])

    def _best_path(self, spans: SpanHash, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over words with equally many characters: edges of the best paths, and their number."""
        m, n = len(edge), edge.shape[1] - 1
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((m, n + 1), np.int64)
        line = np.arange(m)
        for j in range(1, n + 1):
            i = np.arange(max(0, j - self.longest), j)
            at, there = self.probe(spans(edge[:, i], edge[:, [j]]))
            gain = np.where(there, self.scores[at], -np.inf)
            gain[:, -1] = np.where(there[:, -1], gain[:, -1], self.least - UNKNOWN_PENALTY)
            total = best[:, i] + gain
            pick = total.argmax(axis=1)
            best[:, j], back[:, j] = total[line, pick], i[pick]
        path = np.zeros((m, n + 1), np.int64)
        path[:, 0], count, at = n, np.zeros(m, np.int64), np.full(m, n)
        while (at > 0).any():
            going = at > 0
            at = np.where(going, back[line, at], 0)
            count += going
            path[line[going], count[going]] = at[going]
        column = np.arange(n + 1)
        turned = np.take_along_axis(path, np.clip(count[:, None] - column, 0, None), axis=1)
        return np.take_along_axis(edge, turned, axis=1), count

    def encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spans = SpanHash(data)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        first, last = np.searchsorted(lead, start), np.searchsorted(lead, end)
        lead = np.append(lead, len(data))
        n = last - first
        word, left, right = [], [], []
        for k in np.unique(n):
            same = np.flatnonzero(n == k)
            for g in np.split(same, range(GROUP, len(same), GROUP)):
                edge = lead[first[g][:, None] + np.arange(k + 1)]
                edge[:, -1] = end[g]
                if self.kind == "unigram":
                    cut, count = self._best_path(spans, edge)
                elif k > LONG:
                    for i, e in zip(g, edge):
                        one = self._merged_long(spans, e)
                        word.append(np.full(len(one) - 1, i))
                        left.append(one[:-1])
                        right.append(one[1:])
                    continue
                else:
                    cut, count = self._merged(spans, edge)
                real = np.arange(k) < count[:, None]
                word.append(np.repeat(g, count))
                left.append(cut[:, :-1][real])
                right.append(cut[:, 1:][real])
        word, left, right = (np.concatenate(x) for x in (word, left, right))
        order = np.lexsort((left, word))
        word, left, right = word[order], left[order], right[order]
        at, there = self.probe(spans(left, right))
        # a piece, or a byte piece for each byte of an unknown character, or the unknown piece
        by_bytes = ~there & (self.byte_ids[data[left]] >= 0)
        size = np.where(by_bytes, right - left, 1)
        ids = np.repeat(np.where(there, self.piece[at], self.unknown), size)
        place = np.repeat(by_bytes, size)
        ids[place] = self.byte_ids[data[ranges(left[by_bytes], size[by_bytes])]]
        return ids.astype(np.uint32), np.bincount(word, weights=size, minlength=len(start)).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and each text's bounds."""
        data, offsets = flat(texts)
        if _META.encode() in data.tobytes():
            texts = pc.replace_substring(texts, _META, " ")
            data, offsets = flat(texts)
        real = (np.diff(offsets) > 0).astype(np.int64)       # each non-empty text gets the dummy prefix
        shift = np.concatenate([[0], np.cumsum(real)])
        out = np.full(len(data) + int(shift[-1]), 32, np.uint8)
        out[ranges(offsets[:-1] + shift[1:], np.diff(offsets))] = data
        return self.encode_flat(out, offsets + shift)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids; invalid UTF-8 becomes U+FFFD."""
        data = self.bytes[ranges(self.ends[ids] - self.sizes[ids], self.sizes[ids])]
        at = np.concatenate([[0], np.cumsum(self.sizes[ids])])[bounds]
        raw = data.tobytes()
        return [raw[x + (raw[x : x + 1] == b" ") : y].decode(errors="replace") if y > x else ""
                for x, y in zip(at.tolist(), at[1:].tolist())]


_MODELS: dict[tuple[str, str], SentencePieces] = {}


def model(path: str, kind: str = "bpe") -> SentencePieces:
    """The worker's own model, loaded once."""
    if (path, kind) not in _MODELS:
        _MODELS[path, kind] = SentencePieces(path, kind)
    return _MODELS[path, kind]


def encoded(docs: DataFrame, path: str, kind: str = "bpe", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, ``ids`` array) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, kind)
        for b in pieces(batches, text_col, STEP_BYTES):
            ids, bounds = m.encode(b.column(text_col))
            yield pa.RecordBatch.from_pydict({id_col: b.column(id_col).cast(pa.int64()), "ids": pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))})

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` bigint, ids array<int>")


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ``text``) of rows (id, ids); null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            column = b.column("ids")
            sizes = np.array([0 if x is None else x for x in pc.list_value_length(column).to_pylist()], np.int64)
            texts = m.decode(column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
            yield pa.RecordBatch.from_pydict({id_col: b.column(id_col), "text": pa.array(texts, pa.string())})

    return rows.select(id_col, "ids").mapInArrow(run, f"`{id_col}` bigint, text string")


def round_trips(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), and whether decoding gives the text back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, kind)
        for b in pieces(batches, "text", STEP_BYTES):
            ids, bounds = m.encode(b.column("text"))
            back = m.decode(ids, bounds)
            raw = ids.astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").cast(pa.int64()), "n_ids": pa.array(np.diff(bounds), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[x:y]) for x, y in zip(bounds.tolist(), bounds[1:].tolist())], pa.int64()),
                "round_trip": pa.array([(t or "") == u for t, u in zip(b.column("text").to_pylist(), back)])})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean")
