"""Ranked lexical search over a two-level quantised index.

Level 1 of the index has, for each document and term, one byte: the term's
impact rounded upwards. Level 2 has the exact occurrences and the length
factor. A search sums weights times bytes, which bounds every document's
score from above and below at little cost; the k-th largest lower bound of
an item is a threshold that no document of its k best can stay under with
its upper bound. Every document that reaches it is scored exactly, in integers.

The index keeps the terms that the items of a block ask for, so that it is
narrow; it has a row for every document. Rows stay where they are read: a
document's bounds are sums over its own row, so nothing but candidates shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import LOWER, UPPER, stored

#: What a term consists of: ASCII letters and digits, and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CUT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# Fixed values of the score.
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 8
#: No impact reaches SCALE / 1000; bytes count steps of this many units.
STEP = -(-(SCALE // 1000) // 255)
#: Bounds of one block of items, whose weights go to every task.
MOST_ITEMS, MOST_PAIRS = 2_000, 200_000
#: Sums over items and documents that a task makes at a time.
MOST_CELLS, MOST_SUMMANDS = 4_000_000, 2_000_000


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_CUT).split()


def asked(items: DataFrame, text: str) -> DataFrame:
    """q, term, n: how often each item (numbered by q) asks for each term."""
    found = F.regexp_extract_all(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), F.lit(f"({TERM})"), 1)
    return items.select("q", F.explode(found).alias("term")).groupBy("q", "term").agg(F.count(F.lit(1)).alias("n"))


def blocks(pairs: DataFrame, most_items: int, most_pairs: int) -> list[tuple[int, int]]:
    """Ranges of q with at most so many items and pairs each; an item of more pairs is a block of its own."""
    out, first, items, held, last = [], None, 0, 0, None
    for q, n in pairs.groupBy("q").agg(F.count(F.lit(1)).alias("n")).orderBy("q").toLocalIterator():
        if first is not None and (items >= most_items or held + n > most_pairs):
            out.append((first, last))
            first, items, held = None, 0, 0
        first, last, items, held = q if first is None else first, q, items + 1, held + n
    return out if first is None else [*out, (first, last)]


def occurrences(docs: DataFrame, text: str, ident: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """rid, __id, n (terms with repeats), terms (numbers in vocabulary), tfs: a row for every row of docs."""
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"))
    schema = T.StructType().add("rid", "long").add("__id", narrow.schema["__id"].dataType).add("n", "long").add("terms", T.ArrayType(T.IntegerType())).add("tfs", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for body in batch.column(1):
                words = terms_of(body.as_py())
                known, often = np.unique(np.fromiter((t for t in map(vocabulary.get, words) if t is not None), np.int32), return_counts=True)
                lengths.append(len(words))
                terms.append(known)
                tfs.append(often)
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in terms])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind))) for x, kind in ((terms, np.int32), (tfs, np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + len(batch))), batch.column(0), pa.array(lengths, pa.int64()), *lists], names=schema.names)
            number += len(batch)

    return narrow.mapInArrow(run, schema)


def quantised(found: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: rid, terms and impacts (level 1), __id, m and tfs (level 2), of documents that hold an asked term."""
    # 75 n N outgrows 64 bits on a large corpus of long documents; the quotient doesn't
    share = F.expr(f"(cast(cast(n as decimal(19,0)) * cast({LENGTH_SHARE * n_docs} as decimal(19,0)) as decimal(38,0)) div cast({max(1, n_terms)} as decimal(19,0)))")
    rows = found.where(F.size("terms") > 0).withColumn("m", (F.lit(100 - LENGTH_SHARE) + share).cast("long"))
    rows = rows.withColumn("__exact", F.expr(f"transform(tfs, f -> ({SCALE}L * f) div (1000 * f + {SATURATION} * m))"))
    impacts = F.expr(f"transform(__exact, x -> cast((x + {STEP - 1}) div {STEP} as smallint))")
    return rows.select("rid", "terms", impacts.alias("impacts"), "__id", "m", "tfs")


class Weights:
    """The weights of a block's items, by term: items[bounds[t] : bounds[t + 1]] ask for term t."""

    def __init__(self, pairs: list[tuple[int, int, int]], n_terms: int, n_items: int):
        """pairs: (term, item, weight times how often it is asked for)."""
        pairs = sorted(pairs)
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.items, self.weights, self.n_items = table[:, 1], table[:, 2], n_items
        self.bounds = np.searchsorted(table[:, 0], np.arange(n_terms + 1))

    def chunks(self, ends: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, last row, place of the posting, cell, weight) over rows that end at `ends`, as many at a time as the bounds allow."""
        asking = self.bounds[terms + 1] - self.bounds[terms]
        summed = np.concatenate([[0], np.cumsum(asking)])
        starts = np.concatenate([[0], ends[:-1]])
        row = 0
        while row < len(ends):
            to = int(np.searchsorted(summed[ends], summed[starts[row]] + MOST_SUMMANDS, side="right"))
            to = min(max(to, row + 1), row + max(1, MOST_CELLS // max(1, self.n_items)))
            a, b = starts[row], ends[to - 1]
            n = asking[a:b]
            posting = np.repeat(np.arange(a, b), n)
            place = np.arange(len(posting)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.bounds[terms[a:b]], n)
            rows = np.repeat(np.arange(to - row), np.diff(np.concatenate([[a], ends[row:to]])))
            yield row, to, posting, np.repeat(rows, n) * self.n_items + self.items[place], self.weights[place]
            row = to

    def bounds_of(self, cells: int, posting: np.ndarray, cell: np.ndarray, weight: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(upper, lower) bound of each cell's score. Sums stay far below 2^53, so float sums are exact."""
        b = impacts[posting]
        steps = np.bincount(cell, weight * b, cells).astype(np.int64)
        floors = np.bincount(cell, np.where(b > 0, weight, 0), cells).astype(np.int64)
        return steps * STEP, steps * STEP - floors * (STEP - 1)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(ends, values) of a list column."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return ends, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def lower_bounds(index: DataFrame, weights: Weights, k: int) -> DataFrame:
    """item, lower: each task's k largest lower bounds of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((k, weights.n_items), np.int64)
        for batch in batches:
            (ends, terms), (_, impacts) = _lists(batch.column(0)), _lists(batch.column(1))
            for row, to, posting, cell, weight in weights.chunks(ends, terms):
                _, lower = weights.bounds_of((to - row) * weights.n_items, posting, cell, weight, impacts)
                every = np.concatenate([best, lower.reshape(to - row, weights.n_items)])
                best = np.partition(every, len(every) - k, axis=0)[len(every) - k :]
        at, item = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(best[at, item])], names=["item", "lower"])

    return index.select("terms", "impacts").mapInArrow(run, "item int, lower long")


def thresholds(lower: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Each item's k-th largest lower bound; 1 where fewer documents have one."""
    ranked = lower.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("lower")))).where(F.col("r") <= k)
    out = np.ones(n_items, np.int64)
    for item, value in ranked.where(F.col("r") == k).select("item", "lower").collect():  # one number an item of the block
        out[item] = max(1, value)
    return out


def rescored(index: DataFrame, weights: Weights, least: np.ndarray) -> DataFrame:
    """item, rid, __id, score: exact scores of all documents whose upper bound reaches their item's threshold."""
    rows = index.select("terms", "impacts", "tfs", "m", "rid", "__id")
    schema = T.StructType().add("item", "integer").add("rid", "long").add("__id", rows.schema["__id"].dataType).add("score", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ends, terms), (_, impacts), (_, tfs) = (_lists(batch.column(c)) for c in range(3))
            m = np.repeat(batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(np.concatenate([[0], ends])))
            for row, to, posting, cell, weight in weights.chunks(ends, terms):
                upper, _ = weights.bounds_of((to - row) * weights.n_items, posting, cell, weight, impacts)
                reached = upper.reshape(to - row, weights.n_items) >= least
                kept = reached.ravel()[cell]
                posting, cell, weight = posting[kept], cell[kept], weight[kept]
                exact = np.zeros(len(upper), np.int64)
                tf = tfs[posting]
                np.add.at(exact, cell, weight * ((SCALE * tf) // (1000 * tf + SATURATION * m[posting])))
                chosen = np.flatnonzero(reached.ravel() & (exact > 0))
                at = pa.array(chosen // weights.n_items + row)
                yield pa.RecordBatch.from_arrays([pa.array((chosen % weights.n_items).astype(np.int32)), batch.column(4).take(at), batch.column(5).take(at), pa.array(exact[chosen])], names=schema.names)

    return rows.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", ident: str = "doc_id", item_text: str = "text", item_ident: str = "item_id", most_items: int = MOST_ITEMS, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """item_ident, rank (from 1), ident, score: each item's k best documents with a score above 0.

    Equal scores rank by ident ascending, null idents last. Each row of items
    is an item and each row of docs a document, also where idents repeat or are null;
    so repeated rows rank one after the other. Null and empty texts have no
    terms: such items have no result, such documents never score. Texts
    are read whole. Other columns are not touched, whatever their names; if
    both idents have one name, or one of the result's, that is an error. Empty tables give an empty result.

    Items are searched a block at a time (`most_items`, `most_pairs`), each with
    one reading of the documents; what goes to all tasks is bounded by the block.
    """
    if len({ident, item_ident, "rank", "score"}) < 4:
        raise ValueError("idents differ, and neither is rank or score")
    spark = docs.sparkSession
    numbered = stored(items.select(F.col(item_ident).alias("__item"), F.col(item_text).alias("__text")).withColumn("q", F.monotonically_increasing_id()))
    pairs = stored(asked(numbered, "__text"))
    parts = []
    for low, high in blocks(pairs, most_items, most_pairs):
        block = [(r.q, r.term, r.n) for r in pairs.where(F.col("q").between(low, high)).collect()]  # bounded by the block
        names = sorted({t for _, t, _ in block})
        number, item_of = {t: i for i, t in enumerate(names)}, {q: i for i, q in enumerate(sorted({q for q, _, _ in block}))}
        found = stored(occurrences(docs, text, ident, {t.encode("utf-8", "surrogatepass"): i for t, i in number.items()}))
        n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
        weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
        weights_of = {r.t: r.w for r in held.select("t", weight.alias("w")).collect()}  # terms of the block
        weights = Weights([(number[t], item_of[q], n * weights_of[number[t]]) for q, t, n in block if number[t] in weights_of], len(names), len(item_of))
        index = stored(quantised(found, n_docs, n_terms))
        least = thresholds(lower_bounds(index, weights, k), len(item_of), k)
        places = spark.createDataFrame([(i, q) for q, i in item_of.items()], "item int, q long")
        ranked = rescored(index, weights, least).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("__id"), "rid"))).where(F.col("rank") <= k)
        parts.append(ranked.join(F.broadcast(places), "item").join(numbered.select("q", "__item"), "q").select(F.col("__item").alias(item_ident), "rank", F.col("__id").alias(ident), "score"))
    if not parts:
        kinds = {item_ident: items.schema[item_ident].dataType, "rank": "integer", ident: docs.schema[ident].dataType, "score": "long"}
        schema = T.StructType()
        for name, kind in kinds.items():
            schema = schema.add(name, kind)
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
