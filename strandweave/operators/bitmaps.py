"""Sets of positions as bitmap pages: built where the rows are, intersected page by page.

A page holds 32,768 positions of a contig in 4 KB. What shuffles are pages,
however many rows or repeats stand for a position, and a position is looked
up in its page. Where positions are thin, a page is nearly all zeros: then
they are met as words of 64 positions, which are numbers that are added up
and joined in place, and pages are made of what is left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import dealt

PAGE_BITS, WORD_BITS = 32_768, 64
#: Pages of 4 KB that may go to every task after they have been counted; more of them meet the rows in a join by page.
BROADCAST_PAGES = 8_192


def pages(rows: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """keys, page, bits: the positions (from 0) that rows of a key hold. Null and negative positions are left out."""
    numbered = rows.where(F.col(pos) >= 0).select(*keys, (F.col(pos).cast("long") + 1).alias("__n"))  # the bitmap functions count from 1
    page = F.call_function("bitmap_bucket_number", F.col("__n"))
    return numbered.groupBy(*keys, page.alias("page")).agg(F.bitmap_construct_agg(F.call_function("bitmap_bit_position", F.col("__n"))).alias("bits"))


def shared(own: DataFrame, keys: Sequence[str], samples: int) -> DataFrame:
    """keys, page, bits: the positions that all of so many samples hold. own: the samples' pages."""
    met = own.groupBy(*keys, "page").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("__n"))  # a sample has one row a page
    return met.where((F.col("__n") == samples) & (F.bitmap_count("bits") > 0)).drop("__n")


def _in_word(at: Column) -> Column:
    """The word of a position that has only its bit."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (at % WORD_BITS).cast("int"))


def shared_words(rows: DataFrame, sample: str, keys: Sequence[str], pos: str = "pos", samples: int | None = None, tasks: int | None = None) -> DataFrame:
    """keys, word, bits: the positions present in all samples, 64 in a long. Null and negative positions and null samples are left out.

    tasks: that many deal out the rows by word as they are (`session.tasks_for`); without a number each task adds up its own before.
    """
    if samples is None:
        samples = rows.select(sample).distinct().where(F.col(sample).isNotNull()).count()  # one row a sample
    at = F.col(pos).cast("long")
    own = rows.where(F.col(sample).isNotNull() & (F.col(pos) >= 0)).select(sample, *keys, F.shiftright(at, 6).alias("word"), _in_word(at).alias("bits"))
    own = dealt(own, tasks, *keys, "word").groupBy(sample, *keys, "word").agg(F.bit_or("bits").alias("bits"))
    met = own.groupBy(*keys, "word").agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("__n"))  # a sample has one row a word
    return met.where((F.col("__n") == samples) & (F.col("bits") != 0)).drop("__n")


def shared_positions(rows: DataFrame, sample: str, keys: Sequence[str], pos: str = "pos", samples: int | None = None) -> DataFrame:
    """Pages of the positions present in all samples; without a number of samples, that of the distinct ones in rows."""
    words = shared_words(rows, sample, keys, pos, samples)
    bit = F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))).alias("__bit")
    held = words.select(*keys, "word", "bits", bit).where(F.call_function("getbit", F.col("bits"), F.col("__bit")) == 1)
    return pages(held.select(*keys, (F.col("word") * WORD_BITS + F.col("__bit")).alias("pos")), keys)


def union(own: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, page, bits: the positions that any page of a key holds."""
    return own.groupBy(*keys, "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def holding(rows: DataFrame, found: DataFrame, keys: Sequence[str], pos: str = "pos", most_pages: int = BROADCAST_PAGES) -> DataFrame:
    """rows whose position is in its page. Few enough pages go to the rows, which then stay where they are."""
    few = found.limit(most_pages + 1).count() <= most_pages
    named = found.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)], F.col("page").alias("__page"), F.col("bits").alias("__bits"))
    at = F.col(pos).cast("long")
    on = F.call_function("bitmap_bucket_number", at + 1) == F.col("__page")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__p{i}"))
    bit = at % PAGE_BITS
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1
    joined = rows.join(F.broadcast(named) if few else named, on)
    return joined.where(held).drop("__page", "__bits", *[f"__p{i}" for i in range(len(keys))])


def holding_words(rows: DataFrame, found: DataFrame, keys: Sequence[str], pos: str = "pos", tasks: int | None = None) -> DataFrame:
    """rows whose position is in its word of `shared_words`: an equi-join of narrow rows."""
    at = F.col(pos).cast("long")
    left = dealt(rows.withColumn("__word", F.shiftright(at, 6)), tasks, *keys, "__word")
    named = found.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)], F.col("word").alias("__w"), F.col("bits").alias("__bits"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__p{i}"))
    held = F.col("__bits").bitwiseAND(_in_word(at)) != 0
    return left.join(named, on & (F.col("__word") == F.col("__w")) & held).drop("__word", "__w", "__bits", *[f"__p{i}" for i in range(len(keys))])


def positions(found: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """keys, pos: a row for every position of the pages."""
    kinds = ", ".join(f"`{k}` {found.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                part = batch.slice(row, 1)
                bits = np.unpackbits(np.frombuffer(part.column("bits")[0].as_py(), np.uint8), bitorder="little")
                at = np.flatnonzero(bits) + (part.column("page")[0].as_py() - 1) * PAGE_BITS
                whose = pa.array(np.zeros(len(at), np.int64))
                yield pa.RecordBatch.from_arrays([*[part.column(k).take(whose) for k in keys], pa.array(at)], names=[*keys, pos])

    return found.select(*keys, "page", "bits").mapInArrow(run, f"{kinds}, `{pos}` long")
