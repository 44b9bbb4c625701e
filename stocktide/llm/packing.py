"""Packing of tokenised texts into training sequences by vector bin packing.

A sequence has three limits: tokens, segments, and tokens that bear loss. What fills a sequence by itself
is cut off first; each task places the rest of its texts by the dot-product heuristic: of the pieces that fit,
the one whose demands go best with what the sequence has left. A piece is cut where nothing fits, so
that no sequence needs padding, and what a task has left at its end is cut to powers of two.

Tokens of a text are looked up by its words. No token of the vocabulary spans a blank, so that the ids of
a text are those of its words in a row, and every distinct word goes through the tokenizer once per worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import slices, trimmed
from stocktide.llm.tokens import PieceIds

SEQUENCE_TOKENS = 2048
SEQUENCE_SEGMENTS = 64
END_ID = 1
OPEN_PIECES = 1024
SLICE_BYTES = 4 << 20
PIECE_COLUMNS = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, loss_tokens bigint"
)


class WordTokens:
    """Token ids of texts, by way of their distinct words."""

    def __init__(self, path: str):
        self.pieces = PieceIds.of_worker(path)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin; one entry more than texts.

        Blanks part words, and so may a blank put between a letter or digit and the marks behind it,
        which are never one piece. Special tokens inside texts stay as they are spelled.
        """
        texts = texts.fill_null("")
        spelled = pc.match_substring(texts, "<|")
        lower = pc.if_else(spelled, texts, pc.ascii_lower(texts))
        parted = pc.replace_substring_regex(lower, "([0-9a-zß-öø-ÿ])([.,!]+)", r"\1 \2")
        words = pc.split_pattern(pc.replace_substring(parted, "\n", " "), " ")
        ids, begins = self.pieces(words.flatten().cast(pa.binary()))
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
        return ids, begins[offsets]


class _Piece:
    __slots__ = ("doc", "start", "ids", "first_loss", "doc_tokens")

    def __init__(self, doc, start, ids, first_loss, doc_tokens):
        self.doc, self.start, self.ids = doc, start, ids
        self.first_loss, self.doc_tokens = first_loss, doc_tokens

    def loss(self, n: int) -> int:
        """Loss-bearing tokens among the first `n`."""
        return max(0, n - max(0, self.first_loss - self.start))

    def silent(self) -> int:
        """Tokens from the front that bear no loss, also beyond the piece's end."""
        return max(0, self.first_loss - self.start)

    def most(self, tokens: int, loss: int) -> int:
        """The most tokens from the front within both limits."""
        return min(len(self.ids), tokens, self.silent() + loss)

    def cut(self, n: int) -> tuple[_Piece, _Piece | None]:
        make = lambda a, b: _Piece(self.doc, self.start + a, self.ids[a:b], self.first_loss, self.doc_tokens)
        return make(0, n), make(n, len(self.ids)) if n < len(self.ids) else None


class Packer:
    """Sequences of one task. `add` and `finish` give lists of pieces, each list a sequence."""

    def __init__(self, tokens: int, segments: int, loss: int):
        self.limits = np.array([tokens, segments, loss], dtype=float)
        self._empty()

    def _empty(self) -> None:
        """`demands` of the pieces are tokens, a segment, tokens that bear loss; `silent` tokens come first."""
        self.pieces: list[_Piece] = []
        self.demands, self.silent = np.zeros((0, 3)), np.zeros(0)

    def add(self, pieces: list[_Piece]) -> Iterator[list[_Piece]]:
        self._hold(pieces)
        while len(self.pieces) >= OPEN_PIECES:
            yield from self._sequence()

    def finish(self) -> Iterator[list[_Piece]]:
        while self.pieces:
            yield from self._sequence()

    def _hold(self, pieces: list[_Piece]) -> None:
        if pieces:
            new = np.array([(len(p.ids), 1, p.loss(len(p.ids))) for p in pieces], dtype=float)
            self.pieces += pieces
            self.demands = np.concatenate([self.demands, new])
            self.silent = np.concatenate([self.silent, [float(p.silent()) for p in pieces]])

    def _take(self, i: int) -> _Piece:
        piece = self.pieces[i]
        last = self.pieces.pop()
        if i < len(self.pieces):
            self.pieces[i] = last
            self.demands[i], self.silent[i] = self.demands[-1], self.silent[-1]
        self.demands, self.silent = self.demands[:-1], self.silent[:-1]
        return piece

    def _sequence(self) -> Iterator[list[_Piece]]:
        """The next full sequence; in the end, when pieces run out, several that are powers of two long."""
        left, chosen = self.limits.copy(), []
        while self.pieces and left.min() >= 1:
            fits = (self.demands <= left).all(axis=1)
            if fits.any():
                match = self.demands @ (left / self.limits**2)
                match[~fits] = -1
                chosen.append(self._take(int(match.argmax())))
            else:
                most = np.minimum(np.minimum(self.demands[:, 0], left[0]), self.silent + left[2])
                i = int(most.argmax())
                if not most[i]:
                    break
                front, rest = self._take(i).cut(int(most[i]))
                chosen.append(front)
                self._hold([rest] if rest else [])
            n = len(chosen[-1].ids)
            left -= (n, 1, chosen[-1].loss(n))
        total = int(self.limits[0] - left[0])
        if total == self.limits[0] or not self.pieces and total & (total - 1) == 0:
            yield chosen
        elif self.pieces:
            yield self._shortened(chosen, total)
        else:
            while total:
                kept = self._shortened(chosen, total)
                yield kept
                placed = sum(len(p.ids) for p in kept)
                total -= placed
                chosen = self.pieces
                self._empty()

    def _shortened(self, chosen: list[_Piece], total: int) -> list[_Piece]:
        """The sequence cut back to a power of two; what is cut off is held again."""
        size, kept, back = 1 << (total.bit_length() - 1), [], []
        for piece in chosen:
            n = min(size, len(piece.ids))
            size -= n
            if n:
                front, rest = piece.cut(n)
                kept.append(front)
                back += [rest] if rest else []
            else:
                back.append(piece)
        self._hold(back)
        return kept


def _packing(path: str, tokens: int, segments: int, loss: int, with_ids: bool):
    def rows(sequences, first: int, counter: list[int]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(8 + with_ids)]
        for pieces in sequences:
            offset, sequence = 0, first + counter[0]
            counter[0] += 1
            for p in pieces:
                n = len(p.ids)
                row = (p.doc, p.start, n, zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens, sequence,
                       offset, p.loss(n), p.ids)
                for column, value in zip(columns, row):
                    column.append(value)
                offset += n
        kinds = [pa.int64()] * 8 + [pa.list_(pa.int32())] * with_ids
        names = [c.split()[0] for c in PIECE_COLUMNS.split(", ")] + ["ids"] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, counter = TaskContext.get().partitionId() << 36, [0]
        words, packer = None, Packer(tokens, segments, loss)
        for batch in batches:
            words = words or WordTokens(path)
            texts, docs, prompts = batch.column(1), batch.column(0).to_pylist(), batch.column(2)
            for low, high in slices(texts, SLICE_BYTES):
                ids, begins = words(texts.slice(low, high - low))
                before = prompts.slice(low, high - low)
                silent = words(before)[1] if before.null_count < len(before) else np.zeros(len(begins), int)
                ready, loose = [], []
                for i in range(high - low):
                    own = np.append(ids[begins[i] : begins[i + 1]], np.uint32(END_ID))
                    mute = int(silent[i + 1] - silent[i])
                    rest = _Piece(docs[low + i], 0, own, mute, len(own))
                    while rest is not None and rest.most(tokens, loss) == tokens:
                        full, rest = rest.cut(tokens)
                        ready.append([full])
                    if rest is not None:
                        loose.append(rest)
                ready += packer.add(loose)
                yield rows(ready, first, counter)
        yield rows(packer.finish(), first, counter)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    tokens: int = SEQUENCE_TOKENS,
    segments: int = SEQUENCE_SEGMENTS,
    loss_tokens: int = SEQUENCE_TOKENS,
    prompt: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all rows of `docs` (doc_id, text), each with its sequence and its place there.

    A text's ids end with END_ID. With `prompt`, the name of a column that holds the text's beginning, the
    tokens of that beginning bear no loss; else all do. A sequence holds at most `tokens` tokens, of which at most
    `loss_tokens` bear loss, in at most `segments` pieces; it is `tokens` long or a power of two, so that
    nothing is padded. Each id lies in one piece; `start` counts the text's ids before it.

    A null or empty text is the single id END_ID. Rows that repeat an id are texts of their own. A null
    id stays null. Other columns are ignored, and an empty table gives no rows. `tokenizer` is a path
    that every executor can read. Sequences are made within a task, from the rows in their order, so
    that a task run again makes the same ones.
    """
    front = F.lit(None).cast("string") if prompt is None else F.col(prompt).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        front.alias("prompt"),
    )
    schema = PIECE_COLUMNS + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(trimmed(_packing(tokenizer, tokens, segments, loss_tokens, with_ids)), schema)
