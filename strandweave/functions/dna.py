"""Sequence expressions: reverse complement, pyrimidine folding, substitution labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BASES = "ACGT"


def reverse_complement(seq: Column) -> Column:
    """Null unless all bases are A, C, G or T."""
    return F.when(seq.rlike("^[ACGT]+$"), F.translate(F.reverse(seq), "ACGT", "TGCA"))


def fold(tri: Column) -> Column:
    """The pyrimidine-centred form of a 3-mer; null for other letters or lengths. Case counts."""
    purine = F.substring(tri, 2, 1).isin("A", "G")
    return F.when(tri.rlike("^[ACGT]{3}$"), F.when(purine, reverse_complement(tri)).otherwise(tri))


def substitution(ref: Column, alt: Column, tri: Column) -> Column:
    """A[C>T]G label from a change and its folded context; null for equal or other bases."""
    turned = ref.isin("A", "G")
    r, a = (F.when(turned, F.translate(x, "ACGT", "TGCA")).otherwise(x) for x in (ref, alt))
    folded = fold(tri)
    usable = ref.isin(*BASES) & alt.isin(*BASES) & (ref != alt) & folded.isNotNull()
    return F.when(usable, F.concat(F.substring(folded, 1, 1), F.lit("["), r, F.lit(">"), a, F.lit("]"), F.substring(folded, 3, 1)))


def contexts(spark: SparkSession) -> DataFrame:
    """The 32 pyrimidine-centred contexts: tri, ord (by left, centre and right base)."""
    rows = [(a + c + b,) for a in BASES for c in "CT" for b in BASES]
    return spark.createDataFrame([(t, k) for k, (t,) in enumerate(rows)], "tri string, ord int")


def substitutions(spark: SparkSession) -> DataFrame:
    """The 96 substitution types: sbs96, tri, ord (by context, then new base) and fit_ord (by change, then flanks)."""
    by_context = [(a, c, b, x) for a in BASES for c in "CT" for b in BASES for x in BASES if x != c]
    by_change = sorted(by_context, key=lambda t: (t[1], t[3], t[0], t[2]))
    rows = [(f"{a}[{c}>{x}]{b}", a + c + b, k, by_change.index((a, c, b, x))) for k, (a, c, b, x) in enumerate(by_context)]
    return spark.createDataFrame(rows, "sbs96 string, tri string, ord int, fit_ord int")


def round_half_even(x: Column, digits: int) -> Column:
    """Rounding as numpy does it: scale, round half to even, scale back."""
    return F.rint(x * F.lit(float(10**digits))) / F.lit(float(10**digits))


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b != 0, a.cast("double") / b).otherwise(F.lit(0.0))
