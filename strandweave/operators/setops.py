"""Sets across samples: shared positions, private keys, ordered contigs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def shared_space(rows: DataFrame, sample: str, key: Sequence[str], samples: int | None = None) -> DataFrame:
    """Keys present in all samples. Without a number of samples, that of the distinct ones in rows."""
    counted = rows.groupBy(*key, sample).agg(F.lit(1).alias("one")).groupBy(*key).agg(F.count("one").alias("n"))
    if samples is not None:
        return counted.where(F.col("n") == samples).drop("n")
    everyone = rows.select(sample).distinct().agg(F.count(F.lit(1)).alias("everyone"))
    return counted.crossJoin(F.broadcast(everyone)).where("n = everyone").drop("n", "everyone")  # one row


def in_space(rows: DataFrame, space: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(space, list(key), "left_semi")


def samples_holding(rows: DataFrame, sample: str, key: Sequence[str]) -> DataFrame:
    """key, n_samples."""
    return rows.select(*key, sample).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_samples"))


def shared_with_others(rows: DataFrame, holders: DataFrame, own: DataFrame, sample: str, key: Sequence[str]) -> DataFrame:
    """rows with `shared`: the samples besides the row's own that hold its key. own: sample and key pairs."""
    mine = own.select(sample, *key).distinct().withColumn("__own", F.lit(1))
    out = rows.join(holders, list(key), "left").join(mine, [sample, *key], "left")
    return out.withColumn("shared", F.coalesce("n_samples", F.lit(0)) - F.coalesce("__own", F.lit(0))).drop("n_samples", "__own")


def with_shared(rows: DataFrame, sample: str, key: Sequence[str]) -> DataFrame:
    """rows with `shared`: the samples besides the row's own that hold its key, among these rows. One shuffle, by key.

    Rows without a sample or a part of the key are left out.
    """
    known = rows.na.drop(subset=[sample, *key])
    return known.withColumn("shared", F.size(F.collect_set(sample).over(Window.partitionBy(*key))) - 1)  # a set of samples


def ranked(rows: DataFrame, contigs: DataFrame, contig: str = "contig", rank: str = "idx") -> DataFrame:
    """rows with contig_rank: the contig's place in the reference; unknown contigs come after all others.

    contigs: one row to a reference sequence, so it is small.
    """
    known = contigs.select(F.col(contig), F.col(rank).alias("contig_rank"))
    last = contigs.agg((F.coalesce(F.max(rank), F.lit(-1)) + 1).alias("__last"))
    return rows.join(known, contig, "left").crossJoin(F.broadcast(last)).withColumn("contig_rank", F.coalesce("contig_rank", "__last")).drop("__last")


def chosen_contigs(fai: DataFrame, region: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Contigs in reference order after include and exclude lists; the include list wins. Unknown names are errors."""
    names = {r.contig for r in fai.select("contig").collect()}  # a reference has a bounded number of sequences
    unknown = [x for x in (*region, *exclude) if x not in names]
    if unknown:
        raise ValueError(f"not in the reference: {unknown}")
    keep: Column = F.col("contig").isin(*region) if region else ~F.col("contig").isin(*exclude) if exclude else F.lit(True)
    return fai.where(keep).orderBy("idx")
