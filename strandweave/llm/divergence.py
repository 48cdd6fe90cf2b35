"""Source divergence audit: how far the sources of a language differ in their words, exactly.

Texts are read once; every task adds up its own occurrences and documents by
language, source and term, and writes those sums. Count-min sketches of the
terms' document frequencies are built over them, merged, and handed to all
tasks. A sketch never tells too little, so a term that it puts below the
threshold is certainly too rare, and its rows are dropped before anything
shuffles. What is left is counted exactly.

A sketch has a fixed largest size. Where a corpus has more terms than one
holds, they are divided by hash into ranges, each with a sketch of its own,
so that the sketches are equally sharp at every size.

Sources are compared by sums over all kept terms. Terms that a source lacks
have one share in common, so only terms that both sources hold meet in a
join; the others are counted by their number of occurrences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded, stored

#: What a term consists of: ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_CUT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

LEAST_DOCS, TOP = 10, 10
SCALE_DIGITS = 9  # shares are in units of 10^-9
#: Entries of a task's sums; then they are handed on.
MOST_ENTRIES = 300_000
#: Rows of a sketch, and counters (of one byte) of a row: at most 2^22, so 16 MB go to a task.
SKETCH_ROWS, MOST_COUNTERS = 4, 1 << 22
#: Different terms that a sketch takes, as a share of the counters of a row.
LOAD = 0.75
PAGE = 1 << 16


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_CUT).split()


def partial_counts(docs: DataFrame, text: str, lang: str, source: str, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """lang, source, term, n, docs: a task's sums, several rows to a term where they didn't fit at once."""
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, tuple[Counter, Counter]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (language, origin), (n, held) in sums.items():
                if n:
                    terms = pa.array(list(n), pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(n)), pa.array([origin] * len(n)), terms, pa.array(list(n.values()), pa.int64()), pa.array([held[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "docs"]
                    )
            sums.clear()

        entries = 0
        for batch in batches:
            for language, origin, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                n, held = sums.setdefault((language, origin), (Counter(), Counter()))
                words = terms_of(body.as_py())
                before = len(n)
                n.update(words)
                held.update(set(words))
                entries += len(n) - before
                if entries >= most_entries:
                    yield from told()
                    entries = 0
        yield from told()

    return narrow.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _slots(h: np.ndarray, counters: int) -> Iterator[np.ndarray]:
    """A counter's number in every row of the sketch: the hash times odd numbers, upper bits."""
    x, bits = h.view(np.uint64), np.uint64(64 - (counters.bit_length() - 1))
    for k in range(SKETCH_ROWS):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        yield (x >> bits).astype(np.int64) + k * counters


def sketch(partial: DataFrame, counters: int) -> np.ndarray:
    """Count-min document frequencies of partial's hashes (h, docs): tasks' sketches, merged by page; counts stop at 255."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(SKETCH_ROWS * counters, np.uint8)
        for batch in batches:
            h, docs = batch.column(0).to_numpy(), np.minimum(batch.column(1).to_numpy(), 255)
            for slots in _slots(h, counters):
                at, inverse = np.unique(slots, return_inverse=True)
                own[at] = np.minimum(own[at] + np.bincount(inverse, docs).astype(np.int64), 255)
        for page in range(0, len(own), PAGE):
            part = own[page : page + PAGE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([page // PAGE], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["page", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(counts, np.uint8)
                pages[page] = np.minimum(pages[page].astype(np.int16) + found, 255).astype(np.uint8) if page in pages else found
        yield pa.RecordBatch.from_arrays([pa.array(list(pages), pa.int32()), pa.array([p.tobytes() for p in pages.values()], pa.binary())], names=["page", "counts"])

    kind = "page int, counts binary"
    out = np.zeros(SKETCH_ROWS * counters, np.uint8)
    for row in partial.select("h", "docs").mapInArrow(one, kind).repartition("page").mapInArrow(merged, kind).toLocalIterator():  # the sketch's fixed size
        found = np.frombuffer(row.counts, np.uint8)
        out[row.page * PAGE : row.page * PAGE + len(found)] = found
    return out


def possible(partial: DataFrame, counts: np.ndarray, counters: int, least: int) -> DataFrame:
    """The rows of partial whose term may be in `least` documents. A map-side step."""
    shared = partial.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy()
            told = np.full(len(h), 255, np.uint8)
            for slots in _slots(h, counters):
                told = np.minimum(told, shared.value[slots])
            yield batch.filter(pa.array(told >= least))

    return partial.select("h", "lang", "source", "term", "n", "docs").mapInArrow(run, "h long, lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, text: str, lang: str, source: str, least: int = LEAST_DOCS, most_counters: int = MOST_COUNTERS, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """lang, source, term, n of all terms that at least `least` documents of their language hold, exactly."""
    if not 1 <= least <= 255:
        raise ValueError("least is 1 to 255, what a counter holds")
    partial = stored(partial_counts(docs, text, lang, source, most_entries)).withColumn("h", F.xxhash64("lang", "term"))
    different = partial.agg(F.approx_count_distinct("h")).first()[0]
    counters = min(most_counters, max(PAGE, 1 << max(0, int(different / LOAD)).bit_length()))
    ranges = max(1, -(-different // max(1, int(most_counters * LOAD))))
    parts = []
    for k in range(ranges):
        own = partial.where(F.pmod(F.xxhash64("h"), F.lit(ranges)) == k) if ranges > 1 else partial
        exact = possible(own, sketch(own, counters), counters, least).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        # a window holds one row for each source of the language
        held = exact.withColumn("held", F.sum("docs").over(Window.partitionBy("lang", "term"))).where(F.col("held") >= least)
        parts.append(stored(held.select("lang", "source", "term", "n")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of longs."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), three digits at a time, so that 64 bits do at any count."""
    below, rest, out = total + 2 * terms, n + 2, F.lit(0).cast("long")
    for _ in range(SCALE_DIGITS // 3):
        out = out * 1000 + _div(rest * 1000, below)
        rest = (rest * 1000) % below
    return 1 + out


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return _div((p - q) * (p - q), p + q)


def group_sizes(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """lang, source, terms (kept ones of the language), total (their occurrences here), lang_total, absent (the share of a term that isn't here): every occurring group."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    out = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    absent = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("terms", F.lit(1))))
    return out.withColumn("absent", absent)


def top_terms(kept: DataFrame, groups: DataFrame, n_groups: int, top: int) -> DataFrame:
    """lang, source, item, value, rank: each group's terms that it uses more than its language does, the most telling first."""
    whole = kept.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "term")))  # a row for each source of the language
    told = whole.join(bounded(groups, n_groups), ["lang", "source"])
    told = told.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("p > q")
    valued = told.select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def pairs(kept: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """lang, a, b, value of all ordered pairs of different sources of a language.

    Were no term in both, a's terms would differ from b's common share of an absent term, and the reverse; what
    has neither differs by the two absent shares. Terms that both hold are put right in a join.
    """
    g = bounded(groups.select("lang", "source", "total", "terms", "absent"), n_groups)
    side = lambda x: g.select("lang", F.col("source").alias(x), F.col("absent").alias(f"absent_{x}"), F.col("terms").alias(f"terms_{x}"))
    every = groups.select("lang", F.col("source").alias("a"), F.col("absent").alias("absent_a"), F.col("terms").alias("terms_a")).join(side("b"), "lang").where("a <> b")
    neither = F.when(F.col("terms_a") > 0, difference(F.col("absent_a"), F.col("absent_b")))
    base = every.select("lang", "a", "b", F.coalesce(F.col("terms_a") * neither, F.lit(0)).alias("value"))

    shares = kept.join(g, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    # terms of one count have one share: few rows a group, however many terms
    alike = shares.groupBy("lang", F.col("source").alias("a"), "p", F.col("absent").alias("absent_a")).agg(F.count(F.lit(1)).alias("often"))
    alone = alike.join(side("b"), "lang").where("a <> b")
    alone = alone.withColumn("value", F.col("often") * (difference(F.col("p"), F.col("absent_b")) - difference(F.col("absent_a"), F.col("absent_b"))))
    alone = alone.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    one, two = (shares.select("lang", "term", F.col("source").alias(x), F.col("p").alias(f"p_{x}"), F.col("absent").alias(f"absent_{x}")) for x in "ab")
    both = one.join(two, ["lang", "term"]).where("a < b")
    put_right = difference(F.col("p_a"), F.col("p_b")) - difference(F.col("p_a"), F.col("absent_b")) - difference(F.col("absent_a"), F.col("p_b")) + difference(F.col("absent_a"), F.col("absent_b"))
    both = both.groupBy("lang", "a", "b").agg(F.sum(put_right).alias("value"))

    turned = lambda x: x.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    parts = base.unionByName(alone).unionByName(turned(alone)).unionByName(both).unionByName(turned(both))
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, top: int = TOP, most_counters: int = MOST_COUNTERS, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source differs from the others of its language, and by which terms.

    A term is kept in a language that has it in at least `least` documents. A
    term's share in a group is 1 + floor(10^9 (n + 2) / (N + 2 V)) of its n
    occurrences there, N those of all V kept terms. Two shares differ by
    floor((p - q)^2 / (p + q)). Part `pair` has, for every source, each other
    source of its language and the summed difference of all kept terms (0 without any). Part
    `term` has the `top` terms that a source uses more than its language does. Ranks
    begin with 1, larger values first, equal ones by item in UTF-8.

    Null text, language and source count as ''. Texts are read whole, whatever their
    length; repeated rows count each time, as documents of their own. A source
    without terms still is a group. No rows give no rows. Other columns are not touched, whatever their names.
    """
    kept = kept_counts(docs, text, lang, source, least, most_counters, most_entries)
    groups = stored(group_sizes(docs, kept, lang, source))
    n_groups = groups.count()
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    paired = pairs(kept, groups, n_groups).select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    paired = paired.withColumn("rank", F.row_number().over(order))
    terms = top_terms(kept, groups, n_groups, top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return paired.unionByName(terms)
