"""Stupid-backoff language-model scores of whole documents, from counts over the whole corpus.

Documents are exploded into words, a row each: the word, the one after it and those before
it. Rows are dealt out by their word, which is the one before the last of the n-gram that
ends at the word after it. So every count and context of that n-gram lies in one task, which
counts them and adds up the scores by document: count and join share one shuffle. Only a part
of the words is dealt out at a time, so that few of the rows are on disk at once.
Words' own counts come first; the most frequent go to every task, and what is owed
for other words' counts, and for contexts whose word is too frequent for one task, is joined
at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, cut, join_counted, mix, stored, word_hashes

ORDER, BACKOFF, CUTOFF = 3, 0.4, 2

START, END = 0, 1  # stand for words before a document's first and after its last; no word's hash
MOST_WORDS = 1 << 17  # words of one Arrow batch
#: Words of which some are counted before they are sent.
SEEN_WORDS = 1 << 20
#: Words whose counts go to every task.
TOP_WORDS = 1 << 20
#: Rows that one task counts.
TASK_ROWS = 1 << 21


def hashed(text: str | None, known: WordHashes) -> np.ndarray:
    """`word_hashes`, none of them START or END."""
    words = word_hashes(text, known)
    return np.where(words <= END, words + np.uint64(2), words)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """w, often: how often each word occurs. Tasks add up what they have read before they send it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = WordHashes(), [], 0

        def told():
            words, often = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(often)], names=["w", "often"])

        for batch in batches:
            for body in batch.column(0):
                held.append(hashed(body.as_py(), known))
                size += len(held[-1])
                if size >= SEEN_WORDS:
                    yield told()
                    held, size = [], 0
        if size:
            yield told()

    counted = docs.select(F.col(text).cast("string")).mapInArrow(run, "w long, often long")
    return stored(counted.groupBy("w").agg(F.sum("often").alias("often")))


def frequent(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(words, sorted; their counts; whether all others occur once): words that are at least so often, a power of two, that they are `most` at most."""
    sizes = dict(words.groupBy(F.floor(F.log2("often")).alias("power")).count().collect())
    least, n = max(sizes, default=0) + 1, 0
    while least > 0 and n + sizes.get(least - 1, 0) <= most:
        least -= 1
        n += sizes.get(least, 0)
    top = words.where(F.col("often") >= (1 << least)).toArrow()
    names, often = (top.column(c).to_numpy() for c in ("w", "often"))
    order = np.argsort(names.view(np.uint64))
    return names.view(np.uint64)[order], often[order], least <= 1


def shifted(words: np.ndarray, whose: np.ndarray, by: int, beyond: int) -> np.ndarray:
    """The word `by` places later (earlier, if negative) in the same document, or `beyond`."""
    out = np.full(len(words), beyond, np.uint64)
    if abs(by) < len(words):
        to, of = (slice(0, len(words) - by), slice(by, None)) if by > 0 else (slice(-by, None), slice(0, len(words) + by))
        out[to] = np.where(whose[to] == whose[of], words[of], np.uint64(beyond))
    return out


def exploded(named: DataFrame, order: int, hot: np.ndarray, part: int, parts: int) -> DataFrame:
    """doc, w, after, by, b1..b(order - 2): a row for each word of a part of all different ones, with its neighbours.

    named: doc, text. by is the word after a word in hot, so that its rows can be dealt to several tasks.
    """
    before = [f"b{k}" for k in range(1, max(2, order - 1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()

        def told(held, docs):
            whose = np.repeat(np.arange(len(held)), [len(x) for x in held])
            words = np.concatenate(held)
            own = np.flatnonzero((mix(words) >> np.uint64(40)) % np.uint64(parts) == part)
            columns = [words, shifted(words, whose, 1, END), *[shifted(words, whose, -k, START) for k in range(1, len(before) + 1)]]
            w, after, *earlier = (pa.array(x[own].view(np.int64)) for x in columns)
            by = pa.array(columns[1][own].view(np.int64), mask=~np.isin(words[own], hot)) if len(hot) else pa.nulls(len(own), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.array(docs, np.int64)[whose[own]]), w, after, by, *earlier], names=["doc", "w", "after", "by", *before])

        for batch in batches:
            held, docs, size = [], [], 0
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append(hashed(body.as_py(), known))
                docs.append(doc)
                size += len(held[-1])
                if size >= MOST_WORDS:
                    yield told(held, docs)
                    held, docs, size = [], [], 0
            if size:
                yield told(held, docs)

    return named.mapInArrow(run, "doc long, w long, after long, by long, " + ", ".join(f"{b} long" for b in before))


def numbered(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each row, equal where all columns are; how many rows have it). The columns hold numbers under 2^31."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = pd.factorize(key << 32 | c)[0]
    key = key if len(columns) > 1 else pd.factorize(key)[0]
    return key, np.bincount(key)[key]


def found(columns: list[np.ndarray], total: int, top: tuple[np.ndarray, np.ndarray, bool], hot: np.ndarray, order: int, backoff: float, cutoff: int) -> list[tuple]:
    """(name or None, doc or None, n, value) by column: of the rows of one task the scores' sums by document with their words, what is owed, and counts of contexts that others ask for.

    columns: doc, w, after, b1...: all rows of a word, or of a word in hot and the one after it.
    """
    doc, w, after, *before = columns
    n = len(w)
    ids = pd.factorize(np.concatenate([w, after, *before]))[0].reshape(-1, n)
    own, next_, earlier = ids[0], ids[1], ids[2:]
    is_hot = np.isin(w, hot)
    last, first = after == END, before[0] == START

    def often_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, or 1; whether they are known here)"""
        at = np.minimum(np.searchsorted(top[0], words), max(0, len(top[0]) - 1))
        known = top[0][at] == words if len(top[0]) else np.zeros(len(words), bool)
        return np.where(known, top[1][at] if len(top[0]) else 1, 1), known | top[2]

    left, alone = numbered(own)
    alone = np.where(is_hot, often_of(w)[0], alone)
    often, known = often_of(after)
    value, owed_word = np.log(often) - np.log(total), ~known
    owed, asked, counts = np.zeros(n, np.int64), np.zeros((order + 1, n), np.uint64), []
    right, c = numbered(own, next_) if order > 1 else (left, alone)
    context, name = alone, mix(w)
    for k in range(2, order + 1):
        there = ~last
        if k > 2:
            b = earlier[k - 3]
            there = there & (before[k - 3] != START)
            (left, context), (right, c) = numbered(left, b), numbered(right, b)
            name = mix(name + before[k - 3] * np.uint64(3))
            asked[k] = name
            if is_hot.any():
                _, at = np.unique(left[is_hot], return_index=True)
                at = np.flatnonzero(is_hot)[at]
                at = at[before[k - 3][at] != START]
                counts.append((name[at], context[at]))
            context = np.where(is_hot, 1, context)
        used = there & (c >= cutoff)
        value = np.where(used, np.log(c) - np.log(context), np.where(there, value + np.log(backoff), value))
        owed_word &= ~used
        owed = np.where(used, k if k > 2 else 0, owed)
    ends = ~last if order > 1 else np.zeros(n, bool)
    value = np.where(ends, value, 0.0)
    starts = first if order > 1 else np.ones(n, bool)
    value = value + np.where(starts, np.log(alone) - np.log(total), 0.0)
    at, docs = pd.factorize(doc)
    out = [(None, docs, np.bincount(at), np.bincount(at, weights=value))]
    owing = ends & owed_word
    if owing.any():
        out.append((after[owing], doc[owing], np.ones(owing.sum(), np.int64), None))
    owing = ends & is_hot & (owed > 0)
    if owing.any():
        out.append((asked[owed[owing], np.flatnonzero(owing)], doc[owing], np.full(owing.sum(), -1), None))
    return out + [(names, None, often, None) for names, often in counts]


def part_found(rows: DataFrame, total: int, top, hot: np.ndarray, order: int, backoff: float, cutoff: int, tasks: int) -> DataFrame:
    """name, doc, n, value: what the tasks of one part have found, added up by name and document."""
    kept = rows.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if len(b)]
        if not whole:
            return
        columns = [np.concatenate([b.column(k).to_numpy() for b in whole]) for k in range(whole[0].num_columns)]
        whole.clear()
        columns = [columns[0], *[c.view(np.uint64) for c in columns[1:]]]
        for name, doc, n, value in found(columns, total, kept.value, hot, order, backoff, cutoff):
            none = pa.nulls(len(n), pa.int64())
            arrays = [none if name is None else pa.array(name.view(np.int64)), none if doc is None else pa.array(doc), pa.array(n, pa.int64()), pa.array(np.zeros(len(n)) if value is None else value)]
            for at in range(0, len(n), MOST_WORDS):
                yield pa.RecordBatch.from_arrays([x.slice(at, MOST_WORDS) for x in arrays], names=["name", "doc", "n", "value"])

    dealt = rows.repartition(tasks, "w", "by").drop("by")
    every = dealt.mapInArrow(run, "name long, doc long, n long, value double")
    return stored(every.groupBy("name", "doc").agg(F.sum("n").alias("n"), F.sum("value").alias("value")))


def scores(docs: DataFrame, text: str = "text", ident: str = "doc_id", order: int = ORDER, backoff: float = BACKOFF, cutoff: int = CUTOFF, top_words: int = TOP_WORDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row per row of docs: ident, n_words, log_score (natural, summed), mean_log_score.

    S(w | context) is c(context w) / c(context) if the n-gram was counted at
    least `cutoff` times, else `backoff` times S(w | shorter context); for a
    word alone c(w) / N. Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased;
    contexts don't reach over the start of a document. Null and empty texts
    have 0 words and scores of 0. Very long texts are read whole. Repeated rows
    count as often as they are there, and each has its row. Null idents are
    idents like others. Other columns of docs are not touched, whatever their
    names; an ident named like one of the result's columns is an error. An empty table gives an empty one.

    A word that occurs over task_rows / 2 times is dealt out by the words after it; two words that
    follow each other as often are rows of one task.
    """
    if ident in ("n_words", "log_score", "mean_log_score"):
        raise ValueError(f"the ident can't be named {ident}: the result has a column of that name")
    narrow = docs.select(F.col(ident).alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    named = narrow.select("__id", F.xxhash64("__id", "__text").alias("doc"), "__text")
    rows = cut(named.groupBy("__id", "doc").agg(F.count(F.lit(1)).alias("copies")))
    words = word_counts(narrow, "__text")
    total = max(1, words.agg(F.coalesce(F.sum("often"), F.lit(0))).first()[0])
    top = frequent(words, top_words)
    hot = top[0][top[1] > task_rows // 2]
    # what lies on disk at a time is rows of one part; in many tasks they compress less
    parts = 3 if total <= 64 * task_rows else 4
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // (parts * task_rows)))
    told = [part_found(exploded(named.select("doc", "__text"), order, hot, p, parts), total, top, hot, order, backoff, cutoff, tasks) for p in range(parts)]
    every = told[0]
    for x in told[1:]:
        every = every.unionByName(x)
    own = every.where("name is null").select("doc", "n", "value")
    contexts = every.where("doc is null").groupBy("name").agg(F.sum("n").alias("often"))
    owed = every.where("name is not null and doc is not null").select("name", "doc", "n")
    of_words = join_counted(owed.where("n > 0"), words.withColumnRenamed("w", "name"), "name", "often", total)
    of_contexts = join_counted(owed.where("n < 0"), contexts, "name", "often", total)
    owed = of_words.unionByName(of_contexts).select("doc", F.lit(0).cast("long").alias("n"), (F.col("n") * F.log(F.col("often").cast("double"))).alias("value"))
    sums = own.unionByName(owed).groupBy("doc").agg(F.sum("n").alias("n"), F.sum("value").alias("total"))
    told = rows.join(sums, "doc", "left").select("__id", (F.coalesce("n", F.lit(0)) / F.col("copies")).cast("long").alias("n_words"), (F.coalesce("total", F.lit(0.0)) / F.col("copies")).alias("log_score"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return told.select(F.col("__id").alias(ident), "n_words", "log_score", (F.col("log_score") / F.greatest(F.lit(1), "n_words")).alias("mean_log_score"))
