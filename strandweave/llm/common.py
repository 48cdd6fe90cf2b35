"""Shared helpers: durable lineage cuts, size-checked broadcasts, word hashing."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of at most a few dozen bytes that may be broadcast after they have been counted.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints; where a local session has none, one in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if spark.conf.get("spark.checkpoint.dir", None) is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return context.getCheckpointDir()


#: Spark's setting by which a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run in here leave no shuffle files: what they found is in the shared folder."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the cluster's checkpoint folder, so that lost executors don't lose it."""
    shared_folder(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like cut, as a table in columns: for large tables of which later steps read some columns."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are few enough; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def sorted_side(df: DataFrame) -> DataFrame:
    """df with a sort-merge hint, for the joins of loops: many broadcast tables would pile up in the driver."""
    return df.hint("merge")


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def join_counted(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, share: int = 1000) -> DataFrame:
    """rows joined (inner) with one row per key of groups, whatever the skew of rows.

    Keys holding more than 1/share of all rows number fewer than `share`, so
    they are broadcast; the rows of all other keys meet in an ordinary
    shuffled join whose partitions are then bounded.
    """
    hot = groups.where(F.col(size) * share > F.lit(total))
    cold = groups.where(F.col(size) * share <= F.lit(total))
    in_hot = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return in_hot.unionByName(rest.join(cold, key))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, kept between the batches of one task up to a bound."""

    MOST = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of a text, A-Z lower-cased; null is empty.

    bytes.lower() and bytes.split() touch ASCII letters and ASCII white
    space only, which is exactly that definition.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift-multiply rounds); a bijection."""
    x = (x ^ (x >> np.uint64(32))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all word n-grams, in order; a shorter text is one shingle, an empty text has none."""
    if not len(words):
        return words
    width = min(width, len(words))
    out = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        out = mix(out) + words[k : len(words) - width + 1 + k]
    return mix(out + np.uint64(width))
