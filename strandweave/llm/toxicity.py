"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of hashed words, word pairs and pairs with one
word between them. They are made where the rows are read; the fit is one
online pass after another over a bounded sample of labelled rows, with
per-coordinate rates and L1 sparsity, so that few weights are left. Those
are sent to every executor: at most 2^bits numbers, however large the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, bounded, cut, mix, word_hashes

BITS = 20
#: About so many labelled rows at most are learned from, picked by a hash of their ident.
MAX_ROWS = 12_000
_PICK = 1_000_003


@dataclass(frozen=True)
class Ftrl:
    """Rate alpha / (beta + sqrt of summed squared gradients), L1 and L2 strength, passes."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    passes: int = 4


@dataclass(frozen=True)
class Model:
    """bias and the weights that aren't zero; rows: learned from, none give scores of 0."""

    bits: int
    bias: float
    places: np.ndarray
    weights: np.ndarray
    rows: int


def features(words: np.ndarray, bits: int) -> np.ndarray:
    """Hashed places of words, neighbours, and words two apart, with repeats."""
    parts = [mix(words)]
    if len(words) > 1:
        parts.append(mix(mix(words[:-1]) + words[1:]))
    if len(words) > 2:
        parts.append(mix(mix(words[:-2] ^ np.uint64(0xA5A5A5A5)) + words[2:]))
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32)


def learn(rows: list[tuple[int, np.ndarray]], bits: int, how: Ftrl) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, places, weights) from (label, places) rows, in their order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weight(at):
        zz = z[at]
        free = zz - np.sign(zz) * np.where(at == 1 << bits, 0.0, how.l1)  # the bias, last, is not made sparse
        return np.where((np.abs(zz) <= how.l1) & (at != 1 << bits), 0.0, -free / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2))

    for _ in range(how.passes):
        for label, places in rows:
            at = np.append(places, np.int32(1 << bits))
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            was = n[at]
            z[at] += g - (np.sqrt(was + g * g) - np.sqrt(was)) / how.alpha * w
            n[at] = was + g * g
    left = np.flatnonzero(np.abs(z[:-1]) > how.l1)
    return float(weight(np.array([1 << bits]))[0]), left, weight(left)


def fit(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", ident: str = "doc_id", max_rows: int = MAX_ROWS, bits: int = BITS, how: Ftrl = Ftrl()) -> Model:
    """A model from the rows of labels (ident, label 0/1) whose whole texts are in docs.

    Null labels and null idents are ignored. When there are more than
    max_rows labels, those whose hashed ident is in the share that leaves
    about max_rows are used. A label counts once, however many rows of docs have its ident:
    with the first of their texts' features in the order of bytes. Texts are read whole,
    whatever their length, and other columns are not touched.
    """
    known = cut(labels.where(F.col(label).isNotNull() & F.col(ident).isNotNull()).select(F.col(ident), F.col(label).cast("int").alias("__label")))
    total = known.count()
    spread = F.pmod(F.xxhash64(F.col(ident), F.lit(17)), F.lit(_PICK))
    picked = known.where(spread < int(_PICK * min(1.0, max_rows / max(1, total)))).withColumn("__order", F.xxhash64(F.col(ident), F.lit(18)))
    picked = picked.select(F.col(ident).alias("__id"), "__label", "__order", F.monotonically_increasing_id().alias("__key"))
    rows = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text")).join(bounded(picked, min(total, max_rows)), "__id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            made = [np.unique(features(word_hashes(t.as_py(), words), bits)) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([m.astype("<i4").tobytes() for m in made], pa.binary())], names=["key", "order", "label", "places"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(y, np.frombuffer(p, "<i4")) for b in batches for y, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        bias, places, weights = learn(seen, bits, how)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(places, -1), pa.int64()), pa.array(np.append(weights, bias), pa.float64()), pa.array([len(seen)] * (len(places) + 1), pa.int64())], names=["place", "weight", "rows"])

    ready = rows.select("__key", "__order", "__label", "__text").mapInArrow(hashed, "key long, order long, label int, places binary")
    once = ready.groupBy("key", "order", "label").agg(F.min("places").alias("places")).select("order", "label", "places")
    one = once.repartition(1).sortWithinPartitions("order", "label", "places")  # at most about max_rows rows
    found = cut(one.mapInArrow(fitted, "place long, weight double, rows long")).collect()  # at most 2^bits + 1 numbers
    bias = next((r.weight for r in found if r.place < 0), 0.0)
    kept = sorted((r.place, r.weight) for r in found if r.place >= 0)
    return Model(bits, bias, np.array([p for p, _ in kept], np.int64), np.array([w for _, w in kept], np.float64), found[0].rows if found else 0)


def score(docs: DataFrame, model: Model, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """docs with a double column `score`: the probability of label 1 for each whole text.

    Null and empty texts get the model's bias; a model that has learned
    from nothing gives 0. A column named score gives way.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != "score"]
    at = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, m = WordHashes(), sent.value
        dense = np.zeros(1 << m.bits)
        dense[m.places] = m.weights
        for batch in batches:
            sums = []
            for body in batch.column(at):
                places = features(word_hashes(body.as_py(), known), m.bits)
                sums.append(dense[np.unique(places[dense[places] != 0])].sum() + m.bias)
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums), -35, 35))) if m.rows else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    plain = docs.select(*[f"`{c}`" for c in others])
    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("score", DoubleType())]))


def remainder(ident: str):
    """crc32 of the ident as text, modulo 5: rows with 0 are held out."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", ident: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """fit() on the labels that aren't held out."""
    return fit(docs, labels.where(remainder(ident) != 0), label, text, ident, max_rows)


def verdicts(docs: DataFrame, model: Model, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """ident, held_out (false for a null ident), score, predicted; one row per row of docs."""
    scored = score(docs.select(ident, text), model, text, ident)
    return scored.select(ident, F.coalesce(remainder(ident) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """The rows of docs, with all their columns, that score under 0.5.

    Null and empty texts score the model's bias, texts of any length are read whole, repeated
    rows stay or go together, and columns may have any names.
    """
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # no name clashes with the score's
    return score(plain, model, f"c{docs.columns.index(text)}").where("score < 0.5").drop("score").toDF(*docs.columns)
