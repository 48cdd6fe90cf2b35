"""MinHash near-dedup with sequential Bayesian verification.

Documents with the same set of shingles are one vertex. Vertices meet in
the buckets of banded MinHash signatures; a candidate's signatures are then
compared batch by batch, and it goes as soon as the posterior probability
that its similarity reaches the threshold falls under the chosen miss
probability (uniform prior: a beta posterior). Survivors are confirmed on
their full sets. `rounds.link` compares the members of a large bucket with its
best connected one. Of what is still apart there, those pairs are drawn that share
one of their rarest shingles (`rarest_first`): a bound that no link can fail,
so nothing is lost, whatever a bucket's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, bounded, cut, join_counted, shingles, sorted_side, word_hashes
from .rounds import apart, link

HASHES, BATCH, BAND = 128, 32, 5
BANDS = HASHES // BAND
MISS = 1e-6
_CHUNK = 1024


def _random(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 63, size=count, dtype=np.uint64, endpoint=False)


class MinHasher:
    """16-bit MinHash signatures: least of (x ^ b) * a for odd a, kept by its middle bits."""

    def __init__(self, count: int = HASHES, seed: int = 7):
        draws = _random(seed, 2 * count)
        self.a, self.b = (draws[:count] | np.uint64(1))[:, None], draws[count:][:, None]
        self.room = np.empty((count, _CHUNK), np.uint64)

    def sign(self, values: np.ndarray) -> bytes:
        least = np.full(len(self.a), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in range(0, len(values), _CHUNK):
            part = values[None, at : at + _CHUNK]
            room = self.room[:, : part.shape[1]]
            np.bitwise_xor(part, self.b, out=room)
            np.multiply(room, self.a, out=room)
            np.minimum(least, room.min(axis=1), out=least)
        return ((least >> np.uint64(24)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def set_key(values: np.ndarray) -> bytes:
    """128 bits that name a set: two sums of differently mixed members."""
    with np.errstate(over="ignore"):
        one = (values * np.uint64(0x9E3779B97F4A7C15) ^ (values >> np.uint64(31))).sum(dtype=np.uint64)
        two = ((values ^ np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xBF58476D1CE4E5B9) ^ (values >> np.uint64(29))).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def fewest_matches(threshold: float, compared: int, miss: float) -> int:
    """Least matches among `compared` hashes at which P(similarity >= threshold) is at least `miss`.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at the threshold is the chance of at most m successes in n + 1 draws.
    """
    n, below = compared + 1, 0.0
    for m in range(compared + 1):
        below += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if below >= miss:
            return m
    return compared


def signatures(docs: DataFrame, text: str, ident: str, width: int) -> DataFrame:
    """__id, n, set_key, sig of each whole text; n = 0 and nulls for a text without words."""
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher = WordHashes(), MinHasher()
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for body in batch.column(1):
                values = np.unique(shingles(word_hashes(body.as_py(), known), width))
                sizes.append(len(values))
                keys.append(set_key(values) if len(values) else None)
                sigs.append(hasher.sign(values) if len(values) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["__id", "n", "set_key", "sig"])

    return narrow.mapInArrow(run, f"__id {narrow.schema['__id'].dataType.simpleString()}, n long, set_key binary, sig binary")


def full_sets(docs: DataFrame, text: str, width: int) -> DataFrame:
    """set_key, members of each text's set, each set once."""
    narrow = docs.select(F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, len(batch), 64):
                sets = [np.unique(shingles(word_hashes(body.as_py(), known), width)) for body in batch.column(0).slice(at, 64)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set_key", "members"])

    return narrow.mapInArrow(run, "set_key binary, members array<long>").groupBy("set_key").agg(F.first("members").alias("members"))


def plausible(pairs: DataFrame, threshold: float, miss: float = MISS) -> DataFrame:
    """The pairs (a, b, sig_a, sig_b) that no batch of hashes has ruled out: columns a, b."""
    steps = [(n, fewest_matches(threshold, n, miss)) for n in range(BATCH, HASHES + 1, BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, HASHES) for k in (2, 3))
            alive, matches = np.arange(len(batch)), np.zeros(len(batch), np.int64)
            for n, least in steps:
                matches[alive] += (one[alive, n - BATCH : n] == two[alive, n - BATCH : n]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(alive)) for k in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def rarest_first(sets: DataFrame, percent: int) -> DataFrame:
    """token, set_key, n, at: of each set the tokens of which a partner must share one, rarest first.

    Two sets with 100 * |A & B| >= percent * |A | B| share at least
    percent * (|A| + |B|) / (100 + percent) members. Under any order that
    holds for all sets, the first member that they share has at most
    |A| less that many before it in A, and likewise in B. The order is by
    how many of `sets` hold a token: what a copy has changed is rare, so
    copies that have changed too much share none of these. Tokens of one
    set only come first of all, and are left out.
    """
    rows = sets.select("set_key", F.size("members").alias("n"), F.explode("members").alias("token"))
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    told = rows.join(sorted_side(often), "token").groupBy("set_key").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "token"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    most = F.floor(F.col("n") - F.ceil(F.col("n") * percent / 100)).cast("int")  # places before the last that counts, against the smallest partner
    told = told.select("set_key", "n", alone.alias("alone"), "shared", most.alias("most")).where("alone <= most")
    return told.select("set_key", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), F.col("most") - F.col("alone") + 1)).alias("p", "t")).select("t.token", "set_key", "n", (F.col("alone") + F.col("p")).alias("at"))


def may_link(percent: int):
    """Whether the members (n; with `at`: sharing a token at that place) allow a similarity of percent %."""

    def sizes(a: str, b: str):
        return 100 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= percent * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))

    def places(a: str, b: str):
        shared = F.ceil(percent * (F.col(f"{a}.n") + F.col(f"{b}.n")) / (100 + percent))
        return sizes(a, b) & (F.col(f"{a}.at") + shared <= F.col(f"{a}.n")) & (F.col(f"{b}.at") + shared <= F.col(f"{b}.n"))

    return sizes, places


def linked_classes(docs: DataFrame, classes: DataFrame, text: str, ident: str, width: int, percent: int, miss: float) -> DataFrame:
    """v, comp of every class that shares a band with another: comp is the least class that it reaches by links."""
    fewest = math.ceil(percent / (100 - percent))  # smaller sets link with nothing but equals
    bands = F.array(*[F.xxhash64(F.substring("sig", 2 * BAND * k + 1, 2 * BAND), F.lit(k)) for k in range(BANDS)])
    banded = classes.where(F.col("n") >= fewest).select(F.col("set_key").alias("v"), "n", F.explode(bands).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    members = cut(banded.join(sorted_side(shared), "bucket"))
    busy = cut(members.groupBy("v").agg(F.sum("held").alias("deg")))
    members = members.select("bucket", "v", "n").join(sorted_side(busy), "v").select("bucket", "v", "deg", F.struct("n").alias("m"))
    signs = cut(classes.join(sorted_side(busy.select(F.col("v").alias("set_key"))), "set_key", "left_semi").select("set_key", "sig", "rep"))
    reps = cut(signs.select(F.col("rep").alias(ident)).distinct())
    sets = cut(full_sets(docs.select(ident, text).join(bounded(reps, reps.count()), ident, "left_semi"), text, width))
    threshold = percent / 100

    def verify(tried: DataFrame) -> DataFrame:
        near = tried.join(sorted_side(signs.select(F.col("set_key").alias("b"), F.col("sig").alias("sig_b"))), "b").join(sorted_side(signs.select(F.col("set_key").alias("a"), F.col("sig").alias("sig_a"))), "a")
        left = plausible(near, threshold, miss)
        both = left.join(sorted_side(sets.select(F.col("set_key").alias("b"), F.col("members").alias("mb"))), "b").join(sorted_side(sets.select(F.col("set_key").alias("a"), F.col("members").alias("ma"))), "a")
        common = F.size(F.array_intersect("ma", "mb"))
        return both.select("a", "b", common.alias("i"), (F.size("ma") + F.size("mb") - common).alias("u")).where(100 * F.col("i") >= percent * F.col("u")).select("a", "b")

    sizes, places = may_link(percent)
    labels = busy.select("v", F.col("v").alias("comp"))
    labels, rest = link(members, labels, verify, sizes, 1, False)
    rest = apart(rest, labels)
    if rest.isEmpty():
        return labels
    hot = cut(rest.groupBy("v").agg(F.max("deg").alias("deg")))
    tokens = rarest_first(sets.join(sorted_side(hot.select(F.col("v").alias("set_key"))), "set_key", "left_semi"), percent)
    members = tokens.select(F.col("token").alias("bucket"), F.col("set_key").alias("v"), F.struct("n", "at").alias("m")).join(sorted_side(hot), "v")
    return link(members, labels, verify, places, 1, True)[0]


def decisions(docs: DataFrame, text: str = "text", ident: str = "doc_id", width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """One row per row of docs: ident, n_shingles, component_id, kept.

    Links join documents with 100 * |A & B| >= percent * |A | B|, on sets of
    distinct `width`-word shingles; a shorter text is one shingle. component_id
    is the least ident reachable, kept says that it is the document's own.
    Texts that are null, empty or without words have n_shingles 0 and link
    with nothing; so do rows with a null ident, whose component_id is null and
    which are kept. Very long texts are read whole. Rows repeated with the
    same ident get the same answer. An empty table gives an empty one. Other
    columns of docs are not touched, whatever their names.
    """
    signed = cut(signatures(docs, text, ident, width))
    total = signed.count()
    usable = signed.where("n > 0 and __id is not null")
    classes = cut(usable.groupBy("set_key").agg(F.min("__id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    named = classes.select("set_key", "rep", "size")
    if percent >= 100:
        named = named.withColumn("component_id", F.col("rep"))
    else:
        labels = linked_classes(docs, classes, text, ident, width, percent, miss)
        named = cut(named.join(sorted_side(labels.select(F.col("v").alias("set_key"), F.col("comp").alias("label"))), "set_key", "left").withColumn("label", F.coalesce("label", "set_key")))
        least = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("held"))
        named = join_counted(named, least, "label", "held", total).select("set_key", "rep", "size", "component_id")
    told = join_counted(usable.select("__id", "n", "set_key"), named, "set_key", "size", total)
    alone = signed.where("n = 0 or __id is null").select("__id", "n", F.col("__id").alias("component_id"))
    every = told.select("__id", "n", "component_id").unionByName(alone)
    return every.select(F.col("__id").alias(ident), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("__id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", ident: str = "doc_id", width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """docs, all columns, with one document of each component: the one whose ident is least.

    Documents without words and with null idents all stay. Rows repeated
    with the ident that stays are all kept: exact dedup goes before.
    """
    told = decisions(docs, text, ident, width, percent, miss)
    gone = cut(told.where(~F.col("kept")).select(ident).distinct())
    return docs.join(bounded(gone, gone.count()), ident, "left_anti").select(*[f"`{c}`" for c in docs.columns])
