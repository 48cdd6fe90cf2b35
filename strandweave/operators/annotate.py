"""Annotation of candidate changes, in stages whose order matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_annotation(kind: Column, shared: Column, n_mis: Column, threshold: int = 1) -> Column:
    """x: DNM, or GRM if `threshold` other samples hold it, or FPD with mismatches nearby; m: MSM; z: RDM."""
    own = F.when(shared >= threshold, "GRM").when(n_mis > 0, "FPD").otherwise("DNM")
    return F.when(kind == "x", own).when(kind == "m", "MSM").when(kind == "z", "RDM")


def flag_crowded(rows: DataFrame, molecule: list[str], most: int = 5, column: str = "annotation") -> DataFrame:
    """DNMs of molecules that hold `most` DNMs or more become FPD. Contigs don't separate a molecule."""
    known = F.lit(True)
    for c in molecule:
        known = known & F.col(c).isNotNull()
    n = F.count_if(F.col(column) == "DNM").over(Window.partitionBy(*molecule))
    crowded = (F.col(column) == "DNM") & known & (F.col("__n") >= most)
    return rows.withColumn("__n", n).withColumn(column, F.when(crowded, "FPD").otherwise(F.col(column))).drop("__n")


def supported_alone(rows: DataFrame, site: list[str], least: int) -> DataFrame:
    """Collapsed mode: x rows stay if `least` x rows share their site and base."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*site, "kind"))
    return rows.withColumn("__n", n).where((F.col("kind") != "x") | (F.col("__n") >= least)).drop("__n")


def somatic_keys(rows: DataFrame) -> DataFrame:
    """Distinct (sample, contig, pos, alt) of clean double-strand changes."""
    return rows.where("kind not in ('m', 'z') and n_mis = 0").select("sample", "contig", "pos", "alt").distinct()


def flag_supported(rows: DataFrame, support: DataFrame, site: list[str], threshold: int = 1, column: str = "annotation") -> DataFrame:
    """DNMs that `threshold` other samples' reads support become FPD. support: site, n_support."""
    out = rows.join(support, site, "left")
    return out.withColumn(column, F.when((F.col(column) == "DNM") & (F.coalesce("n_support", F.lit(0)) >= threshold), "FPD").otherwise(F.col(column)))
