"""Substitution spectra, corrected for how often each context could be seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dna import fold, ratio, substitution, substitutions
from .kmers import completed


def context_tally(context: DataFrame, tri: str = "tri", depth: str = "depth") -> DataFrame:
    """tri, positions, total_depth of the 32 contexts: rows and summed depth by folded context; letters' case counts."""
    folded = context.withColumn("tri", fold(F.col(tri))).where("tri is not null")
    counted = folded.groupBy("tri").agg(F.count(F.lit(1)).alias("positions"), F.sum(F.col(depth).cast("long")).alias("total_depth"))
    return completed(counted, "positions").na.fill(0, ["total_depth"])


def counts96(changes: DataFrame, key: list[str]) -> DataFrame:
    """sbs96, tri, ord, counts: distinct changes (key) by type, all 96. changes: ref, alt, tri and the key."""
    distinct = changes.dropDuplicates(key).groupBy("ref", "alt", "tri").agg(F.count(F.lit(1)).alias("n"))
    # '' stands for no type: a test for null would be pushed below both groupings and label every row
    label = F.coalesce(substitution(F.col("ref"), F.col("alt"), F.col("tri")), F.lit(""))
    counted = distinct.groupBy(label.alias("sbs96")).agg(F.sum("n").alias("counts"))
    return substitutions(changes.sparkSession).join(counted, "sbs96", "left").na.fill(0, ["counts"])


def alternative(first: Column, second: Column) -> Column:
    """The first strand's base, or the second's where that is '' or '.'."""
    return F.when(first.isin("", ".") | first.isNull(), second).otherwise(first)


def share(value: Column) -> Column:
    """Share of a column's total over all rows (96 or 32 of them); 0 if the total is."""
    return ratio(value, F.sum(value).over(Window.partitionBy()))


def corrected(spectrum: DataFrame, observed: str, expected: str, name: str) -> DataFrame:
    """spectrum with name = counts * freq(expected) / freq(observed), 0 for contexts never observed, and name_frac."""
    value = F.when(F.col(observed) > 0, F.col("counts") * F.col(expected) / F.col(observed)).otherwise(F.lit(0.0))
    return spectrum.withColumn(name, value).withColumn(f"{name}_frac", share(F.col(name)))


def normalise(counts: DataFrame, tally: DataFrame, genome: DataFrame | None = None, human: DataFrame | None = None) -> DataFrame:
    """The 96-row table of counts and corrected counts.

    counts: counts96(). tally: context_tally(). genome, human: tri, n; without
    them the positions called stand for the genome, and the genome for the human one.
    normcounts corrects by the genome's composition, normcounts_new by that
    of the positions called, human_normcounts by the human genome's.
    """
    contexts32 = tally.select("tri", "positions", "total_depth")
    for name, table, otherwise in (("genome_n", genome, "positions"), ("human_n", human, "genome_n")):
        if table is None:
            contexts32 = contexts32.withColumn(name, F.col(otherwise))
            continue
        contexts32 = contexts32.join(table.select("tri", F.col("n").alias(name)), "tri", "left").na.fill(0, [name])
    contexts32 = contexts32.select("*", share(F.col("total_depth")).alias("freq_c"), share(F.col("genome_n")).alias("freq_g"), share(F.col("positions")).alias("freq_r"), share(F.col("human_n")).alias("freq_h"))
    table = counts.join(contexts32, "tri").withColumn("frac", share(F.col("counts")))
    for name, expected in (("normcounts", "freq_g"), ("normcounts_new", "freq_r"), ("human_normcounts", "freq_h")):
        table = corrected(table, "freq_c", expected, name)
    table = table.withColumn("g_over_c", ratio(F.col("freq_g"), F.col("freq_c"))).withColumn("r_over_c", ratio(F.col("freq_r"), F.col("freq_c")))
    return table.withColumn("sub", F.substring("sbs96", 3, 3))
