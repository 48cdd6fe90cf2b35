"""Read filters: a first-failure cascade that also says why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dna import ratio

# SAM flag bits and CIGAR operation codes.
PAIRED, PROPER, UNMAPPED, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 0x1, 0x2, 0x4, 0x100, 0x200, 0x400, 0x800
M, I, D, N, S, H, P, EQ, X = range(9)


def cascade(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; null if none does. A null rule doesn't hold."""
    out = None
    for name, rule in rules:
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out


def tally(rows: DataFrame, reason: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows by reason (kept: 'kept')."""
    return rows.withColumn("reason", F.coalesce(reason, F.lit("kept"))).groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n"))


def bits(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) != 0


def cigar_total(cigar: Column, ops: Sequence[int]) -> Column:
    return F.aggregate(F.filter(cigar, lambda o: o["op"].isin(*ops)), F.lit(0), lambda t, o: t + o["len"])


def identity() -> Column:
    """1 - mismatches / query length, rounded to 3 places."""
    return F.round(1 - ratio(F.col("nm"), F.length("seq")), 3)


def softclip() -> Column:
    """Share of the query outside the alignment."""
    return 1 - ratio(cigar_total(F.col("cigar"), (M, I, EQ, X)), F.length("seq"))


def read_reason(min_mapq=60, min_ec=5.0, min_qlen=800, max_qlen=10_000, max_softclip=0.2, min_identity=0.99) -> Column:
    """Why a molecule's read is dropped. A soft-clipped share equal to the maximum is dropped too."""
    return cascade(
        [
            ("not_primary", bits(F.col("flag"), SECONDARY | SUPPLEMENTARY)),
            ("mapq", F.col("mapq") < min_mapq),
            ("ec", F.col("ec") < min_ec),
            ("short", F.length("seq") < min_qlen),
            ("long", F.length("seq") > max_qlen),
            ("softclip", softclip() >= max_softclip),
            ("identity", identity() < min_identity),
        ]
    )


def raw_coverage_read(min_mapq=20) -> Column:
    """Reads that count for raw coverage; supplementary ones do."""
    return ~bits(F.col("flag"), UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE) & (F.col("mapq") >= min_mapq)


def pileup_read(min_mapq=30) -> Column:
    """Reads that count in a pileup."""
    flag = F.col("flag")
    orphan = bits(flag, PAIRED) & ~bits(flag, PROPER)
    usable = F.col("qual").isNotNull() & F.col("cigar").isNotNull() & (F.size("cigar") > 0)
    return ~bits(flag, UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE | SUPPLEMENTARY) & ~orphan & (F.col("mapq") >= min_mapq) & usable
