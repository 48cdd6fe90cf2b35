"""Shared change and context tables -> the table of 96 types, corrected for opportunity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.genomes import preset
from ..operators import spectrum
from ..sources import sinks

#: Columns of the table and what `spectrum.normalise` calls them.
COLUMNS = {
    "sub": "sub",
    "tri": "tri",
    "sbs96": "sbs96",
    "counts": "counts",
    "frac": "frac",
    "normcounts": "normcounts",
    "normfrac": "normcounts_frac",
    "normcounts_new": "normcounts_new",
    "normfrac_new": "normcounts_new_frac",
    "freq_C(c)": "freq_c",
    "freq_G(c)": "freq_g",
    "freq_G(c)_new": "freq_r",
    "freq_G/freq_C(c)": "g_over_c",
    "freq_G(c)_new/freq_C(c)": "r_over_c",
    "genome_tri_count": "genome_n",
    "ref_callable_tri_count": "positions",
    "duplex_callable_tri_count": "total_depth",
    "Human_normcounts": "human_normcounts",
    "Human_normfrac": "human_normcounts_frac",
    "freq_G_human": "freq_h",
    "human_tri_count": "human_n",
}


def somatic_changes(rows: DataFrame) -> DataFrame:
    """contig, start, end, ref, alt, tri of a shared change table's DNM rows (`tables.changes`).

    alt is the first strand's base, or the second's where the first has none.
    Rows of tables without an annotation column are left out.
    """
    base = lambda c: F.substring_index(c, ":", 1)
    return rows.where("annotation = 'DNM'").select("contig", "start", "end", "ref", spectrum.alternative(base("strand_1"), base("strand_2")).alias("alt"), "tri")


def table96(changes: DataFrame, context: DataFrame, genome: DataFrame) -> DataFrame:
    """The 21 columns of one sample's corrected spectrum, and ord.

    changes: contig, start, end, ref, alt, tri; each place and new base counts
    once, whatever the number of molecules. context: tri, depth of the shared
    callable positions. genome: tri, n. Human columns are by GRCh38.
    """
    counts = spectrum.counts96(changes, ["contig", "start", "end", "alt"])
    return named(spectrum.normalise(counts, spectrum.context_tally(context), genome, preset(changes.sparkSession, "GRCh38")))


def named(table: DataFrame) -> DataFrame:
    return table.select("ord", *[F.col(source).alias(name) for name, source in COLUMNS.items()])


def write(table: DataFrame, path: str, first: str) -> None:
    """Tab-separated text: one line of remarks (`first`), the header, 96 rows in order."""
    if not first.startswith("#"):
        raise ValueError("the first line is a remark: it begins with #")
    sinks.as_headed_text(table, path, [first, "\t".join(COLUMNS)], list(COLUMNS), ["ord"])
