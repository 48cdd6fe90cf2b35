"""Changes of many samples -> the shared space, annotations, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dna import ratio
from ..functions.stats import poisson_interval
from ..operators import annotate, bitmaps, pileup, setops


def shared_space(context: DataFrame) -> DataFrame:
    """contig, page, bits: the positions that all samples can call, as bitmap pages."""
    return bitmaps.shared_positions(context, "sample", ["contig"], "start")


def shared_context(context: DataFrame) -> DataFrame:
    """Context rows at positions that all samples can call."""
    return bitmaps.holding(context, shared_space(context), ["contig"], "start")


def annotated(changes: DataFrame, context: DataFrame, threshold: int = 1, most: int = 5, min_alt_support: int = 1, collapsed: bool = False) -> DataFrame:
    """Changes in the shared space with shared and annotation, before reads are consulted.

    changes: sample, contig, pos, zm, kind, alt, n_mis. Which samples hold a
    change is told from all changes, in the shared space or not.
    """
    keys = annotate.somatic_keys(changes)
    holders = setops.samples_holding(keys, "sample", ["contig", "pos", "alt"])
    rows = bitmaps.holding(changes, shared_space(context), ["contig"])
    if collapsed:
        rows = annotate.supported_alone(rows, ["sample", "contig", "pos", "alt"], min_alt_support)
    rows = setops.shared_with_others(rows, holders, keys, "sample", ["contig", "pos", "alt"])
    rows = rows.withColumn("annotation", annotate.first_annotation(F.col("kind"), F.col("shared"), F.col("n_mis"), threshold))
    return annotate.flag_crowded(rows, ["sample", "zm"], most)


def checked(rows: DataFrame, reads: DataFrame, samples: DataFrame, threshold: int = 1, min_alt_support: int = 1, min_mapq: int = 30, min_baseq: int = 70) -> DataFrame:
    """rows with DNMs turned to FPD where other samples' reads support them; counts for rows that were DNMs.

    samples: sample, ord.
    """
    dnm = rows.where("annotation = 'DNM'")
    counts = pileup.count_alleles(reads, pileup.sites_of_others(dnm, samples), min_mapq, min_baseq)
    backed = pileup.support(dnm, counts, samples, min_alt_support)
    out = rows.withColumn("__was", F.col("annotation") == "DNM")
    out = annotate.flag_supported(out, backed, ["sample", "contig", "pos", "alt"], threshold)
    return out.withColumn("counts", F.when(F.col("__was"), F.col("counts"))).drop("__was", "n_support")


def rates(rows: DataFrame, context: DataFrame) -> DataFrame:
    """sample, mut_rate, poisson_ci_lo, poisson_ci_hi, tot_muts, tot_bps: DNM molecules over callable bases."""
    found = rows.groupBy("sample").agg(F.count_if(F.col("annotation") == "DNM").alias("tot_muts"))
    bases = context.groupBy("sample").agg(F.sum(F.col("depth").cast("long")).alias("tot_bps"))
    joined = bases.join(found, "sample", "left").na.fill(0, ["tot_muts"]).withColumn("ci", poisson_interval("tot_muts"))
    return joined.select("sample", ratio(F.col("tot_muts"), F.col("tot_bps")).alias("mut_rate"), ratio(F.col("ci.lower"), F.col("tot_bps")).alias("poisson_ci_lo"), ratio(F.col("ci.upper"), F.col("tot_bps")).alias("poisson_ci_hi"), "tot_muts", "tot_bps")


def single_sample(changes: DataFrame, context: DataFrame, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """(changes with annotation, rates) of one sample alone: nothing is shared, the whole context counts."""
    first = changes.withColumn("annotation", annotate.first_annotation(F.col("kind"), F.lit(0), F.col("n_mis")))
    rows = annotate.flag_crowded(first, ["sample", "zm"], most)
    return rows, rates(rows, context)
