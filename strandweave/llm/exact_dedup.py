"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 reads every text once and keeps a narrow table of its hash. Two
bits per hash are counted, and the bits that were hit more than once
become a bit array (`bitmap_construct_agg`) of a fixed largest size, which
may therefore be broadcast. Pass 2 probes it: a row with either bit unset
is certainly unique and passes straight through; only possibly repeated
rows shuffle, and those are settled on the whole SHA-256. A full filter
makes more rows shuffle, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, cut, join_counted

#: Largest filter: 2^27 bits are 16 MB, whatever the corpus.
MAX_FILTER_BITS = 1 << 27
PAGE_BITS = 32_768  # bits of one bitmap row


def normalised(text: Column) -> Column:
    """What makes texts equal: A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


def fingerprint(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _slots(key: Column, bits: int) -> list[Column]:
    """One bit in either half of the filter, numbered from 1."""
    half = bits // 2
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(half)) + F.lit(k * half + 1) for k in (0, 1)]


def filter_bits(rows: int, most: int = MAX_FILTER_BITS) -> int:
    """About 16 bits a row as a power of two, within the bound."""
    return max(2 * PAGE_BITS, min(most, 1 << max(0, 16 * rows - 1).bit_length()))


def repeated_filter(hashes: DataFrame, key: str, bits: int) -> DataFrame:
    """Pages (page, page_bits) of the bits that at least two rows hit."""
    hit = hashes.select(F.explode(F.array(*_slots(F.col(key), bits))).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return hit.groupBy(F.expr("bitmap_bucket_number(slot)").alias("page")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("page_bits"))


def possibly_repeated(rows: DataFrame, key: str, pages: DataFrame, bits: int) -> DataFrame:
    """rows with a boolean column __maybe: both of its bits are set. A map-side step."""
    out = rows
    for k, slot in enumerate(_slots(F.col(key), bits)):
        page = F.broadcast(pages.select(F.col("page").alias(f"__page{k}"), F.col("page_bits").alias(f"__bits{k}")))
        out = out.withColumn(f"__slot{k}", slot).withColumn(f"__page{k}", F.expr(f"bitmap_bucket_number(__slot{k})")).join(page, f"__page{k}", "left")
        out = out.withColumn(f"__pos{k}", F.expr(f"bitmap_bit_position(__slot{k})"))
        byte = F.expr(f"cast(conv(hex(substring(__bits{k}, cast(__pos{k} div 8 as int) + 1, 1)), 16, 10) as int)")
        out = out.withColumn(f"__set{k}", F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), F.col(f"__pos{k}") % 8)), F.lit(2)) == 1, F.lit(False)))
        out = out.drop(f"__slot{k}", f"__page{k}", f"__bits{k}", f"__pos{k}")
    return out.withColumn("__maybe", F.col("__set0") & F.col("__set1")).drop("__set0", "__set1")


def decisions(docs: DataFrame, text: str = "text", ident: str = "doc_id", max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of docs: ident, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest ident stays; null idents rank lowest. Rows
    repeated with the same ident count as separate rows of which one stays.
    Null and empty texts are equal. An empty table gives an empty table.
    """
    hashes = cut(docs.select(F.col(ident).alias("__id"), F.unhex(fingerprint(F.col(text))).alias("__sha")).withColumn("__uid", F.monotonically_increasing_id()))
    total = hashes.count()
    bits = filter_bits(total, max_filter_bits)
    probed = possibly_repeated(hashes, "__sha", cut(repeated_filter(hashes, "__sha", bits)), bits)
    unique = probed.where(~F.col("__maybe")).select("__sha", "__id", "__uid", F.struct(F.col("__id"), F.col("__uid")).alias("__keep"), F.lit(1).cast("long").alias("__n"))
    maybe = probed.where("__maybe").drop("__maybe")
    groups = maybe.groupBy("__sha").agg(F.max(F.struct("__id", "__uid")).alias("__keep"), F.count(F.lit(1)).alias("__n"))
    settled = join_counted(maybe, groups, "__sha", "__n", total)
    return unique.unionByName(settled.select(*unique.columns)).select(
        F.col("__id").alias(ident), F.col("__keep")["__id"].alias("keep_id"), F.col("__n").alias("group_size"), (F.col("__keep")["__uid"] == F.col("__uid")).alias("kept"), F.lower(F.hex("__sha")).alias("text_sha256")
    )


def distinct_rows(docs: DataFrame, text: str = "text", ident: str = "doc_id", max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """The rows of docs, with all their columns, that stay.

    Certainly unique rows pass without a shuffle. Of the others, each task
    sends on its best row of each text, so a hot text never meets in full.
    Rows equal in text and ident: one of them stays. Null and empty texts are
    equal, null idents rank lowest, texts of any length are read whole, an empty
    table stays empty, and other columns are kept, whatever their names.
    """
    if not docs.columns:
        return docs
    key = fingerprint(F.col(text))
    hashes = cut(docs.select(F.unhex(key).alias("__sha")))
    bits = filter_bits(hashes.count(), max_filter_bits)
    pages = cut(repeated_filter(hashes, "__sha", bits))
    # the row travels as one column, so that none of its names clash
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.struct(F.col(ident)).alias("__id"), F.unhex(key).alias("__sha"))
    probed = possibly_repeated(packed, "__sha", pages, bits)
    best = probed.where("__maybe").groupBy("__sha").agg(F.max_by("__row", "__id").alias("__row")).select("__row.*")
    return probed.where(~F.col("__maybe")).select("__row.*").unionByName(best)
