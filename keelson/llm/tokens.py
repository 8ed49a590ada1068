"""Token ids of many texts: each distinct unit is encoded once per Python worker.

A byte-level BPE's pre-tokenizer always cuts before a space that precedes a
non-space character, so a text's ids are those of its units (cut there) in a
row. Units are told apart by 64-bit span hashes; new ones are encoded by the
tokenizer, several in one string, and kept in a bounded cache; the ids of all
units are then gathered by numpy. Texts are encoded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from keelson.llm.textbytes import SPACE, SpanHash, flat, ranges

#: Units in the cache before it starts anew, units in one string, strings encoded at once (an encoding takes far more
#: memory than its ids), bytes of text handled at once.
CACHE_UNITS, JOINED, STRINGS, STEP_BYTES = 500_000, 256, 16, 2 << 20

# First bytes of the multi-byte code points among which there are white spaces: not cut before.
_UNSURE = SPACE.copy()
_UNSURE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class UnitEncoder:
    """Encodes texts by their distinct units; subclasses cut the units and encode new ones."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all units, and each text's bounds among them."""
        raise NotImplementedError

    def encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these units in a row, and the number of each."""
        raise NotImplementedError

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and each text's bounds."""
        return self.encode_flat(*flat(texts))

    def encode_flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, bounds = self.units(data, offsets)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        h, first, inverse = np.unique(SpanHash(data)(start, end), return_index=True, return_inverse=True)
        if len(self.known) > CACHE_UNITS:
            self._clear()
        place = np.searchsorted(self.known, h)
        found = place < len(self.known)
        found[found] = self.known[place[found]] == h[found]
        if not found.all():
            new = first[~found]
            ids, count = self.encode_units(data, start[new], end[new])
            at = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, ids])
            self.known = np.concatenate([self.known, h[~found]])
            order = np.argsort(self.known, kind="stable")
            self.known = self.known[order]
            self.at, self.count = np.concatenate([self.at, at])[order], np.concatenate([self.count, count])[order]
            place = np.searchsorted(self.known, h)
        at, count = self.at[place][inverse], self.count[place][inverse]
        ends = np.concatenate([[0], np.cumsum(count)])
        return self.ids[ranges(at, count)], ends[bounds]


class BpeEncoder(UnitEncoder):
    """Encodes Arrow texts with a byte-level BPE of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)      # a byte-level token has one character a byte

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.zeros(len(data), bool)
        if len(data):
            cut[:-1] = (data[:-1] == 32) & ~_UNSURE[data[1:]]
            real = offsets[1:] > offsets[:-1]
            cut[offsets[1:][real] - 1] = False
            cut[offsets[:-1][real]] = True
        start = np.flatnonzero(cut)
        ends = np.concatenate([start[1:], [len(data)]])[: len(start)]
        return start, ends, np.searchsorted(start, offsets)

    def encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        texts = [raw[x:y].decode() for x, y in zip(start.tolist(), end.tolist())]
        joins = [i for i, t in enumerate(texts) if t[0] == " "]
        alone = [i for i, t in enumerate(texts) if t[0] != " "]
        strings = ["".join(texts[i] for i in joins[k : k + JOINED]) for k in range(0, len(joins), JOINED)]
        strings += [texts[i] for i in alone]
        order = np.array(joins + alone, np.int64)
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        ids = np.concatenate([np.array(e.ids, np.uint32) for i in range(0, len(strings), STRINGS)
                              for e in encode(strings[i : i + STRINGS], add_special_tokens=False)])
        # units end where as many bytes of tokens have passed
        edge = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum((end - start)[order])) + 1
        count = np.diff(edge, prepend=0)
        out = np.empty(len(order), np.int64)
        out[order] = count
        first = np.empty(len(order), np.int64)
        first[order] = edge - count
        return ids[ranges(first, out)], out


_ENCODERS: dict[str, BpeEncoder] = {}


def encoder(path: str) -> BpeEncoder:
    """The worker's own encoder, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BpeEncoder(path)
    return _ENCODERS[path]
