"""Concatenate and cut: one stream of tokens over all documents, cut into fixed windows.

Pass 1 encodes every text where it is read, appends the end id and writes the
ids with each document's place in its own partition. The partitions' totals,
one number a task, are added up to give every partition its offset in the
stream. Pass 2 cuts the stored ids at the windows' bounds without a shuffle:
a document's place is its partition's offset plus its own.

Windows are `capacity` tokens. What is left over at the very end is cut by
the binary digits of its length, so that its windows are powers of two and
no sequence needs padding.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import stored
from .tokens import MOST_BYTES, tokenizer_path, word_ids

CAPACITY, END = 4096, 2
#: Bytes of ids that a task holds before it hands them on; a longer document is a batch of its own.
HELD_BYTES = 8_000_000
PIECE_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def encoded(docs: DataFrame, text: str, ident: str, tokenizer: str, end: int, memory_bytes: int = MOST_BYTES) -> DataFrame:
    """__id, part, before, n, ids: each text's ids and `end` as little-endian 32-bit words.

    part is the task that read the row and before the tokens that this task read before it.
    """
    stop = struct.pack("<I", end)
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"))
    schema = T.StructType().add("__id", narrow.schema["__id"].dataType).add("part", "long").add("before", "long").add("n", "long").add("ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, before = word_ids(tokenizer, memory_bytes), TaskContext.get().partitionId(), 0
        for batch in batches:
            first, held, size = 0, [], 0
            for k, body in enumerate(batch.column(1)):
                held.append(ids_of.encode(body.as_py() or "") + stop)
                size += len(held[-1])
                if size >= HELD_BYTES or k == len(batch) - 1:
                    lengths = [len(x) // 4 for x in held]
                    places = [before]
                    for n in lengths:
                        places.append(places[-1] + n)
                    before = places.pop()
                    columns = [batch.column(0).slice(first, len(held)), pa.array([part] * len(held), pa.int64()), pa.array(places, pa.int64()), pa.array(lengths, pa.int64()), pa.array(held, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                    first, held, size = k + 1, [], 0

    return narrow.mapInArrow(run, schema)


def offsets(ids: DataFrame) -> tuple[DataFrame, int]:
    """(part, part_offset: where each task's tokens begin in the whole stream; the length of the stream)."""
    totals = sorted((r.part, r.n) for r in ids.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one number a task
    rows, at = [], 0
    for part, n in totals:
        rows.append((part, at))
        at += n
    return ids.sparkSession.createDataFrame(rows, "part long, part_offset long"), at


def tail_windows(total: int, capacity: int) -> list[tuple[int, int, int]]:
    """(sequence_id, from, to) of what full windows leave over: the largest power of two first."""
    number, at, out = total // capacity, total - total % capacity, []
    while at < total:
        size = 1 << (total - at).bit_length() - 1
        out.append((number, at, at + size))
        number, at = number + 1, at + size
    return out


def windows(at: Column, to: Column, total: int, capacity: int) -> Column:
    """array<struct<sequence_id,a,b>>: the windows that [at, to) of the stream touches."""
    full = total // capacity
    first, last = F.floor(at / capacity), F.least(F.floor((to - 1) / capacity), F.lit(full - 1))
    whole = F.transform(F.sequence(first, last), lambda w: F.struct(w.alias("sequence_id"), (w * capacity).alias("a"), ((w + 1) * capacity).alias("b")))
    kind = "array<struct<sequence_id:bigint,a:bigint,b:bigint>>"
    out = F.when(first <= last, whole.cast(kind)).otherwise(F.array().cast(kind))
    tail = tail_windows(total, capacity)
    if not tail:
        return out
    rest = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip(("sequence_id", "a", "b"), w, strict=True)]) for w in tail])
    return F.concat(out, F.filter(rest, lambda w: (w["a"] < to) & (w["b"] > at)))


def cut(
    docs: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    memory_bytes: int = MOST_BYTES,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ident, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids: little-endian 32-bit words).

    The pieces of a sequence fill it from 0 without a gap; each token of
    each document is in exactly one. All sequences hold `capacity` tokens
    but for at most log2(capacity) at the end of the stream, whose lengths are
    powers of two. Null and empty texts are the end id alone. Texts are
    encoded whole, whatever their length. Rows repeated with the same ident,
    null idents among them, are documents of their own. An empty table gives an
    empty one. Other columns of docs are not touched, whatever their names;
    an ident named like one of the result's columns is an error.
    """
    if ident in (*PIECE_COLUMNS, "ids"):
        raise ValueError(f"the ident can't be named {ident}: the result has a column of that name")
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity is a power of two")
    ids = stored(encoded(docs, text, ident, tokenizer or tokenizer_path("word_bpe_49k.json"), end, memory_bytes))
    begins, total = offsets(ids)
    placed = ids.join(F.broadcast(begins), "part").withColumn("at", F.col("part_offset") + F.col("before")).withColumn("to", F.col("at") + F.col("n"))

    def piece(w):
        a, b = F.greatest(w["a"], F.col("at")), F.least(w["b"], F.col("to"))
        bytes_of = F.substring(F.col("ids"), ((a - F.col("at")) * 4 + 1).cast("int"), ((b - a) * 4).cast("int"))
        fields = {"start": a - F.col("at"), "length": b - a, "ids_crc32": F.crc32(bytes_of), "sequence_id": w["sequence_id"], "offset": a - w["a"]}
        return F.struct(*[c.alias(n) for n, c in fields.items()], *([bytes_of.alias("ids")] if with_ids else []))

    pieces = placed.select("__id", F.col("n").alias("doc_tokens"), F.explode(F.transform(windows(F.col("at"), F.col("to"), total, capacity), piece)).alias("p"))
    return pieces.select(F.col("__id").alias(ident), "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset", *(["p.ids"] if with_ids else []))


def sequences(pieces: DataFrame, ident: str = "doc_id") -> DataFrame:
    """sequence_id, ids (array of int), boundaries (ident, start, offset, length in order): training sequences of `cut(..., with_ids=True)`.

    A group is one sequence, so at most `capacity` tokens meet in one place.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "start", F.col(ident).alias("ident"), "ids")))
    met = pieces.groupBy("sequence_id").agg(parts.alias("parts"))

    def numbers(body: Column) -> Column:
        at = F.sequence(F.lit(0), F.octet_length(body) - 4, F.lit(4))
        turned = lambda k: F.concat(*[F.substring(body, k + j, F.lit(1)) for j in (4, 3, 2, 1)])
        return F.transform(at, lambda k: F.conv(F.hex(turned(k)), 16, 10).cast("int"))

    told = F.transform("parts", lambda p: F.struct(p["ident"].alias(ident), p["start"].alias("start"), p["offset"].alias("offset"), p["length"].alias("length")))
    return met.select("sequence_id", F.flatten(F.transform("parts", lambda p: numbers(p["ids"]))).alias("ids"), told.alias("boundaries"))
