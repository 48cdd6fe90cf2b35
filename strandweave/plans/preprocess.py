"""Reads of one or more samples -> callable context, classified changes, reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.dna import ratio, round_half_even
from ..operators import filters, intervals, molecules, walk
from ..operators.filters import tally
from ..operators.setops import ranked
from ..session import small


@dataclass(frozen=True)
class Options:
    min_mapq: int = 60
    min_identity: float = 0.99
    min_bq: int = 93
    min_qlen: int = 800
    max_qlen: int = 10_000
    min_depth: int = 1
    trim: float = 50
    indel_pad: int = 10
    mismatch_window: int = 20
    quality_window: int = 20
    min_ec: float = 5.0
    max_softclip: float = 0.2
    z_share: int = 0
    collapsed: bool = False


def filtered(reads: DataFrame, o: Options) -> DataFrame:
    """reads with `reason`, null for those that stay."""
    return reads.withColumn("reason", filters.read_reason(o.min_mapq, o.min_ec, o.min_qlen, o.max_qlen, o.max_softclip, o.min_identity))


def read_report(reads: DataFrame, o: Options) -> DataFrame:
    """sample, contig, reason, n."""
    return tally(reads, filters.read_reason(o.min_mapq, o.min_ec, o.min_qlen, o.max_qlen, o.max_softclip, o.min_identity), ("sample", "contig"))


def raw_coverage(reads: DataFrame, contigs: DataFrame, o: Options) -> DataFrame:
    """sample, contig, length, raw_coverage, max_depth."""
    span = F.aggregate(F.filter("cigar", lambda c: c["op"].isin(*walk.REFERENCE_OPS)), F.lit(0), lambda t, c: t + c["len"])
    spans = reads.where(filters.raw_coverage_read()).select("sample", "contig", F.col("pos").alias("start"), (F.col("pos") + F.greatest(span, F.lit(1))).alias("end"))
    known = spans.join(contigs.select("contig", "length"), "contig")
    means = known.groupBy("sample", "contig", "length").agg(F.sum(intervals.covered(F.col("start"), F.col("end"), F.col("length"))).alias("bases"))
    mean = F.format_string("%.2f", F.col("bases") / F.col("length")).cast("double")
    return means.select("sample", "contig", "length", mean.alias("raw_coverage"), intervals.depth_cap(mean, o.min_depth).alias("max_depth"))


def high_coverage(reads: DataFrame, contigs: DataFrame, o: Options) -> DataFrame:
    """sample, contig, start, end where the raw depth reaches the contig's cap."""
    span = F.aggregate(F.filter("cigar", lambda c: c["op"].isin(*walk.REFERENCE_OPS)), F.lit(0), lambda t, c: t + c["len"])
    spans = reads.where(filters.raw_coverage_read()).select("sample", "contig", F.col("pos").alias("start"), (F.col("pos") + F.greatest(span, F.lit(1))).alias("end"))
    capped = spans.join(raw_coverage(reads, contigs, o).select("sample", "contig", "max_depth"), ["sample", "contig"])
    return intervals.at_least(capped, F.col("max_depth"), ["sample", "contig"])


def calls(reads: DataFrame, reference: DataFrame, o: Options) -> DataFrame:
    """Classified positions of all molecules."""
    kept = filtered(reads, o).where("reason is null").drop("reason")
    if o.collapsed:
        return walk.classify_collapsed(kept, reference, o.min_bq, o.trim, o.indel_pad, o.quality_window, o.z_share)
    bases = walk.duplex_bases(kept, reference, o.trim, o.indel_pad, o.quality_window)
    return walk.classify_duplex(bases, o.min_bq, o.mismatch_window, o.z_share)


def walked(reads: DataFrame, tiles: DataFrame, o: Options, size: int = molecules.TILE) -> DataFrame:
    """All molecules, a row each: their records and runs of callable positions. tiles: `molecules.reference_tiles`.

    What `calls` tells of every base, without a row a base; `context_of`, `changes_of`, `coverage_report`
    and `metrics` all go on from here, so the result is best kept (`session.durable`, or written).
    """
    kept = filtered(reads, o).where("reason is null").drop("reason")
    rules = molecules.Rules(o.min_bq, o.mismatch_window, o.quality_window, o.z_share, o.trim, o.indel_pad)
    return molecules.walked(kept, tiles, rules, o.collapsed, size)


def context_of(walked: DataFrame, tiles: DataFrame, masked: DataFrame, o: Options, size: int = molecules.TILE) -> DataFrame:
    """`context` from molecules: depths are swept over runs, which become positions at the very end."""
    deep = molecules.depth_runs(walked).where(F.col("depth") >= o.min_depth)
    told = molecules.with_contexts(deep, tiles, size).where("instr(tri, 'N') = 0")
    return intervals.unmasked(told, masked, ["sample", "contig"]).select("sample", "contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "tri", "depth")


def changes_of(walked: DataFrame, masked: DataFrame, o: Options) -> DataFrame:
    """`changes` from molecules: a record's depth is that of the run it lies in."""
    records = _with_strands(molecules.records(walked), o)
    spans = molecules.depth_runs(walked).select("sample", "contig", F.col("start").alias("__from"), F.col("end").alias("__to"), "depth")
    deep = intervals.range_join(records, spans, ["sample", "contig"], "pos", "__from", "__to").drop("__from", "__to").where(F.col("depth") >= o.min_depth)
    if o.min_depth <= 0:
        nowhere = intervals.range_join(records, spans, ["sample", "contig"], "pos", "__from", "__to", how="left_anti")
        deep = deep.unionByName(nowhere.withColumn("depth", F.lit(0)))
    return intervals.unmasked(deep.withColumnRenamed("start", "read_start").withColumnRenamed("end", "read_end") if o.collapsed else deep, masked, ["sample", "contig"])


def callable_bases(called: DataFrame, by: list[str]) -> DataFrame:
    """by, callable_bps: of classified positions, or of molecules."""
    if "n_callable" in called.columns:
        return called.groupBy(*by).agg(F.sum("n_callable").alias("callable_bps")).where("callable_bps > 0")
    return called.where("callable").groupBy(*by).agg(F.count(F.lit(1)).alias("callable_bps"))


def ordered_high_coverage(high: DataFrame, header: DataFrame) -> DataFrame:
    """Rows of high_coverage in the order of the alignments' header (contig, idx), then by start; contigs the header lacks come last."""
    return ranked(high, header).orderBy("sample", "contig_rank", "start").select("sample", "contig", "start", "end")


def mask(reads: DataFrame, contigs: DataFrame, low_complexity: DataFrame | None, o: Options) -> DataFrame:
    """sample, contig, start, end: low-complexity intervals and those of too high coverage, merged."""
    high = high_coverage(reads, contigs, o)
    if low_complexity is not None:
        samples = small(reads.select("sample").distinct())  # one row a sample
        high = high.unionByName(low_complexity.select("contig", "start", "end").crossJoin(samples))
    return intervals.merge(high, ["sample", "contig"])


def context(called: DataFrame, reference: DataFrame, masked: DataFrame, o: Options) -> DataFrame:
    """sample, contig, start, end, tri, depth: callable positions deep enough, with whole contexts, unmasked."""
    deep = walk.depth(called).where(F.col("depth") >= o.min_depth)
    told = deep.join(reference.select("contig", "pos", "tri"), ["contig", "pos"]).where("tri is not null and length(tri) = 3 and instr(tri, 'N') = 0")
    return intervals.unmasked(told, masked, ["sample", "contig"]).select("sample", "contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "tri", "depth")


def _with_strands(records: DataFrame, o: Options) -> DataFrame:
    """records with alt and what the strands say."""
    alt = F.col("base") if o.collapsed else F.when(F.col("base_1") != F.col("ref"), F.col("base_1")).otherwise(F.col("base_2"))
    strands = {"strand_1": walk.strand_call(), "strand_2": F.lit(None).cast("string")} if o.collapsed else {f"strand_{k}": walk.strand_call(f"_{k}") for k in (1, 2)}
    return records.withColumns({"alt": alt, **strands})


def changes(called: DataFrame, masked: DataFrame, o: Options) -> DataFrame:
    """The records (kinds x, m, z) deep enough and unmasked, with alt, depth and what the strands say (strand_1, strand_2)."""
    depths = walk.depth(called)
    records = _with_strands(called.where("kind is not null"), o)
    deep = records.join(depths, ["sample", "contig", "pos"], "left").withColumn("depth", F.coalesce("depth", F.lit(0))).where(F.col("depth") >= o.min_depth)
    return intervals.unmasked(deep.withColumnRenamed("start", "read_start").withColumnRenamed("end", "read_end") if o.collapsed else deep, masked, ["sample", "contig"])


def coverage_report(called: DataFrame, contigs: DataFrame, raw: DataFrame) -> DataFrame:
    """sample, contig, length, callable_bps, duplex_coverage, raw_coverage, max_depth."""
    sums = callable_bases(called, ["sample", "contig"])
    every = raw.select("sample", "contig", "length", "raw_coverage", "max_depth").join(sums, ["sample", "contig"], "left").na.fill(0, ["callable_bps"])
    return every.withColumn("duplex_coverage", round_half_even(F.col("callable_bps") / F.col("length"), 2))


def lacking_a_strand(reads: DataFrame, o: Options) -> DataFrame:
    """Filtered reads whose molecule has no second strand."""
    from ..operators.pairing import strand, unpaired

    return unpaired(filtered(reads, o).where("reason is null").withColumn("strand", strand(F.col("qname"))), ["sample", "contig", "zm"], "strand")


#: Counters of a report by the reason of the read filter.
DISCARDED = {
    "disc_no_primary": "not_primary",
    "disc_mapq_qual": "mapq",
    "disc_min_ec": "ec",
    "disc_min_qlen": "short",
    "disc_max_qlen": "long",
    "disc_max_soft": "softclip",
    "disc_min_identity": "identity",
}


def metrics(reads: DataFrame, called: DataFrame, contigs: DataFrame, o: Options) -> DataFrame:
    """One row a sample: counters of reads, molecules and bases, coverage, and the percentages told with them.

    pct_ of a reason is its share of the discarded reads; that of num_discarded and num_zmw
    the share of all reads (a duplex has two). Shares of nothing are 0.
    """
    from ..operators.pairing import in_order, still_waiting, strand

    kept = filtered(reads, o)
    counters = [F.count(F.lit(1)).alias("num_reads"), F.count("reason").alias("failed"), *[F.count_if(F.col("reason") == r).alias(n) for n, r in DISCARDED.items()]]
    told = kept.groupBy("sample").agg(*counters)
    left = kept.where("reason is null")
    if o.collapsed:
        molecules = left.groupBy("sample").agg(F.count(F.lit(1)).alias("num_zmw"), F.lit(0).cast("long").alias("disc_lack_compl"))
    else:
        keys, sided = ["sample", "contig", "zm"], left.select("sample", "contig", "zm", "input_ord", strand(F.col("qname")).alias("strand"))
        pairs = in_order(sided, keys, "strand", "input_ord").where("strand = 'fwd'").groupBy("sample").agg(F.count(F.lit(1)).alias("num_zmw"))
        molecules = pairs.join(still_waiting(sided, keys, "strand", "input_ord").groupBy("sample").agg(F.count(F.lit(1)).alias("disc_lack_compl")), "sample", "full")
    bases = callable_bases(called, ["sample"])
    length = contigs.agg(F.sum("length").cast("long").alias("total_length_ref"))  # one row
    out = told.join(molecules, "sample", "left").join(bases, "sample", "left").na.fill(0, ["num_zmw", "disc_lack_compl", "callable_bps"]).crossJoin(F.broadcast(length))
    out = out.withColumn("num_discarded", F.col("failed") + F.col("disc_lack_compl")).withColumn("coverage", round_half_even(ratio(F.col("callable_bps"), F.col("total_length_ref")), 2))
    share = lambda a, b: round_half_even(ratio(F.col(a), F.col(b)) * 100, 2)
    parts = [(share("num_zmw", "num_reads") * (1 if o.collapsed else 2)).alias("pct_zmw"), share("num_discarded", "num_reads").alias("pct_discarded")]
    parts += [share(n, "num_discarded").alias(n.replace("disc_", "pct_")) for n in (*DISCARDED, "disc_lack_compl")]
    return out.select("sample", "num_reads", "num_zmw", "num_discarded", *DISCARDED, "disc_lack_compl", "callable_bps", "total_length_ref", "coverage", *parts)


def metrics_json(report: DataFrame) -> DataFrame:
    """sample, json: a report's row as one JSON object."""
    return report.select("sample", F.to_json(F.struct(*[F.col(c) for c in report.columns])).alias("json"))
