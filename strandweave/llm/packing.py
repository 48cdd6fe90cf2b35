"""Best-fit packing of token sequences: bounded-space online best fit.

Documents become pieces of at most `capacity` tokens where they are read;
only the pieces' numbers travel. They are dealt evenly to tasks of a fixed
number of pieces, so tasks grow in number, not in size, with the corpus.
Within a task the pieces come in the order of a hash, and each goes to the
open bin with the least room that still holds it. Open bins are kept by free
space, with a bitset telling which free spaces occur; at most `open_bins` are
open, and the fullest closes first. Pieces are placed as they come but for a
short look-ahead: of each `look_ahead` of them the longest goes first, which
makes fewer sequences and needs no more memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import cut
from .tokens import MOST_BYTES, tokenizer_path, word_ids

CAPACITY = 2048
OPEN_BINS, LOOK_AHEAD = 1_024, 2_048
PIECES_PER_TASK = 60_000
PIECES_SCHEMA = "piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Open bins by free space; place() tells where a piece goes."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bitset = 0  # bit f: some open bin has f tokens free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = self.forced = 0  # forced: bins that closed to make room for others

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bitset &= ~(1 << free)
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to capacity tokens."""
        fits = self.bitset >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bitset & -self.bitset).bit_length() - 1)  # the fullest closes
                self.open -= 1
                self.forced += 1
            free, number = self.capacity, self.made
            self.made += 1
            self.open += 1
        rest = free - length
        if rest:
            self.by_free[rest].append(number)
            self.bitset |= 1 << rest
        else:
            self.open -= 1
        return number, self.capacity - free


def placed(lengths: np.ndarray, bins: OpenBins, look_ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of pieces in the order they come; of each look_ahead of them the longest is placed first."""
    where = np.zeros((len(lengths), 2), np.int64)
    for at in range(0, len(lengths), look_ahead):
        for k in at + np.argsort(-lengths[at : at + look_ahead], kind="stable"):
            where[k] = bins.place(int(lengths[k]))
    return where[:, 0], where[:, 1]


def pieces(docs: DataFrame, text: str, ident: str, tokenizer: str, capacity: int = CAPACITY, end: int = 0, memory_bytes: int = MOST_BYTES) -> DataFrame:
    """ident, piece, start, length, ids_crc32 of every document's ids plus the id `end`."""
    stop = end.to_bytes(4, "little")
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"))
    kind = narrow.schema["__id"].dataType.simpleString()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer, memory_bytes)
        for batch in batches:
            rows: list[tuple] = []
            idents = []
            for ident_, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of.encode(body.as_py() or "") + stop
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    idents.append(ident_)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(idents, batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))],
                names=["__id", "piece", "start", "length", "ids_crc32"],
            )

    return narrow.mapInArrow(cut_up, f"__id {kind}, {PIECES_SCHEMA}").withColumnRenamed("__id", ident)


def pack(
    docs: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    look_ahead: int = LOOK_AHEAD,
    pieces_per_task: int = PIECES_PER_TASK,
    memory_bytes: int = MOST_BYTES,
) -> DataFrame:
    """One row per piece: ident, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone, one piece of length 1. Rows
    repeated with the same ident are packed separately. A document longer
    than capacity is cut into full pieces and a rest; no other is cut.
    An empty table gives an empty table. memory_bytes bounds what a worker
    remembers of words, twice; it changes the speed, never the rows. Other columns are not
    touched, whatever their names; an ident named like one of the result's columns is an error.
    """
    if ident in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset"):
        raise ValueError(f"the ident can't be named {ident}: the result has a column of that name")
    made = cut(pieces(docs, text, ident, tokenizer or tokenizer_path("word_bpe_49k.json"), capacity, memory_bytes=memory_bytes))
    tasks = max(1, -(-made.count() // pieces_per_task))
    # the cut above and this order make every placement the same when a task is run again
    dealt = made.repartition(tasks).sortWithinPartitions(F.xxhash64(ident, "piece", "ids_crc32"), ident, "piece", "ids_crc32")
    where = len(made.columns) - 2  # the length column

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            number, offset = placed(batch.column(where).to_numpy(), bins, look_ahead)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first + number), pa.array(offset)],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return dealt.mapInArrow(place, f"`{ident}` {made.schema[ident].dataType.simpleString()}, {PIECES_SCHEMA}, sequence_id long, offset long")
