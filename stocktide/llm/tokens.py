"""Token ids of whole texts, by way of their distinct pieces.

A tokenizer works on pieces of a text one by one. Texts repeat most of their pieces, so that each distinct
one goes through the tokenizer once per worker process and is looked up from then on.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa

from stocktide.llm.text import utf8

#: Pieces that are remembered, and their bytes; what goes beyond starts afresh.
PIECES_KEPT = 600_000
BYTES_KEPT = 64 << 20


def worker_cache() -> dict:
    """A dict that lives as long as the worker process. Functions travel to it by value, so that their own
    globals last for one task only."""
    name = "_stocktide_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].kept = {}
    return sys.modules[name].kept


class PieceIds:
    """Ids of the distinct pieces met so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    @staticmethod
    def of_worker(path: str) -> PieceIds:
        kept = worker_cache()
        if path not in kept:
            kept[path] = PieceIds(path)
        return kept[path]

    def _forget(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.bytes = self.used = 0
        self.lengths = np.zeros(1 << 16, dtype=np.int64)
        self.begins = np.zeros(1 << 16, dtype=np.int64)
        self.pool = np.zeros(1 << 18, dtype=np.uint32)

    @staticmethod
    def _grown(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, len(array)), array.dtype)])

    def _learn(self, pieces: list[bytes]) -> None:
        new = [p for p in pieces if p not in self.codes]
        if not new:
            return
        if len(self.codes) + len(new) > PIECES_KEPT or self.bytes > BYTES_KEPT:
            self._forget()
            new = pieces
        texts = [p.decode("utf-8", "replace") for p in new]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        first, n = len(self.codes), len(new)
        lengths = np.fromiter(map(len, found), np.int64, n)
        total = int(lengths.sum())
        self.lengths, self.begins = (self._grown(a, first + n) for a in (self.lengths, self.begins))
        self.pool = self._grown(self.pool, self.used + total)
        self.lengths[first : first + n] = lengths
        self.begins[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used : self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        self.codes.update(zip(new, range(first, first + n)))
        self.used += total
        self.bytes += sum(map(len, new))

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all `pieces` (binary) in a row, and where each piece's begin; one entry more than pieces."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        code_of = np.fromiter((self.codes[p] for p in distinct), np.int64, len(distinct))
        codes = code_of[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else code_of[:0]
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.begins[codes] - (ends - lengths), lengths) + np.arange(total)
        return self.pool[places], np.concatenate([[0], ends])


def _byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_SOLID = _byte_table((0x21, 0x7E))
_LEAD_OF_TWO = _byte_table((0xC3, 0xDF))  # no white space among the characters these begin
_BEGINS_SOLID = _SOLID | _LEAD_OF_TWO
_MARKS = _byte_table((0x2C, 0x2C), (0x2E, 0x2E), (0x21, 0x21), (0x3F, 0x3F), (0x3A, 0x3B))
_ALNUM = _byte_table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_BLANK = _byte_table((0x0A, 0x0A), (0x20, 0x20))


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a byte-level tokenizer always begins a token.

    These are the texts' beginnings, a single blank or line break between characters that are none, what follows
    such a line break, and marks behind an ASCII letter or digit. Of the tokenizer's own rule (an optional
    blank and a run of letters, of digits or of other characters; runs of white space) no token reaches
    over one of them. More places may be such; longer pieces only cost time.
    """
    n = len(data)
    starts = np.zeros(n + 1, dtype=bool)
    if n > 2:
        ends_solid = _SOLID[data]
        ends_solid[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & _LEAD_OF_TWO[data[:-1]]
        lone = _BLANK[data[1:-1]] & ends_solid[:-2] & _BEGINS_SOLID[data[2:]]
        starts[1 : n - 1] |= lone
        starts[2:n] |= lone & (data[1:-1] == 0x0A)
        starts[1:n] |= _MARKS[data[1:]] & _ALNUM[data[:-1]]
    starts[offsets] = True
    starts[n] = False
    return np.flatnonzero(starts[:n])


def byte_level_ids(texts: pa.Array, pieces: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of `texts` under a byte-level tokenizer without normaliser, and where each text's begin; one entry
    more than texts. A null is an empty text."""
    data, offsets = utf8(texts)
    starts = piece_starts(data, offsets)
    bounds = np.append(starts, len(data)).astype(np.int64)
    cut = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    ids, begins = pieces(cut)
    return ids, begins[np.searchsorted(starts, offsets)]
