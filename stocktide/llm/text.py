"""Words of Arrow string columns as 64-bit hashes, computed on the UTF-8 bytes with numpy.

All functions take whole texts. Bytes are worked on in blocks of about a megabyte, so that memory does
not depend on how long one text is beyond the text itself and eight bytes for each of its words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def not_space() -> np.ndarray:
    """Byte classes of words `[^\\x20\\x09-\\x0D]+`."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def alphanumeric() -> np.ndarray:
    """Byte classes of words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of lower-cased text."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(1, 257, dtype=np.uint64)
    table[0x41:0x5B] += np.uint64(0x20)
    return table


_LOWER = _lower()


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x + np.uint64((_ODD * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column) or column.buffers()[1] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _blocks(is_word: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges that end behind a byte outside words, or with the data."""
    start = 0
    while start < len(data):
        end = min(start + BLOCK_BYTES, len(data))
        while end < len(data) and is_word[data[end - 1]]:
            step = data[end : end + BLOCK_BYTES]
            outside = np.flatnonzero(~is_word[step])
            end = end + int(outside[0]) + 1 if len(outside) else end + len(step)
        yield start, end
        start = end


def word_hashes(column: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word with A-Z lower-cased, and where each text's words begin among them.

    The hash is a polynomial of the bytes modulo 2^64, taken from running sums, then mixed with the
    word's length. The second array has one entry more than there are texts.
    """
    data, offsets = utf8(column)
    inner = offsets[1:-1]
    hashes, begins = [], []
    power = inverse = np.zeros(0, dtype=np.uint64)
    for low, high in _blocks(is_word, data):
        part = data[low:high]
        if len(power) < len(part):
            power, inverse = _powers(_ODD, len(part)), _powers(_INVERSE, len(part))
        inside = is_word[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = inner[(inner >= low) & (inner < high)] - low
        first[cuts] = inside[cuts]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        gaps = np.flatnonzero(~inside)
        following = np.searchsorted(gaps, starts)
        ends = np.full(len(starts), len(part), dtype=np.int64)
        within = following < len(gaps)
        ends[within] = gaps[following[within]]
        ends[:-1] = np.minimum(ends[:-1], starts[1:])
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_LOWER[part] * power[: len(part)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * inverse[starts]
        hashes.append(mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48))))
        begins.append(starts + low)
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` consecutive words; of the whole sequence if it is shorter; none of no words."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        total = mix(total ^ words[i : i + n], seed=i)
    return total


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a column of about `limit` bytes of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    start = 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        yield start, end
        start = end


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def trimmed(task: Task) -> Task:
    """`task`, after which its worker gives back the memory it no longer uses: workers outlive their tasks, and
    those that wait would hold what the largest of them took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not the GNU C library
            pass

    return run
