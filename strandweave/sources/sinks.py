"""Results as tables and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def as_table(rows: DataFrame, path: str, order: list[str], partition: list[str] | None = None) -> None:
    """Parquet, sorted within files so that row groups can be skipped by position."""
    out = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists")
    (out.partitionBy(*partition) if partition else out).parquet(path)


def rendered_strand(strand):
    """ALT:QUAL:QPOS:EC:SM:QLEN:SIM:MEAN:SD of a strand struct; null is '.'."""
    parts = [F.coalesce(strand[f].cast("string"), F.lit(".")) for f in ("alt", "qual", "qpos", "ec", "sm", "qlen", "sim", "mean", "sd")]
    return F.when(strand.isNull(), ".").otherwise(F.concat_ws(":", *parts))


def rendered_counts(counts):
    """A:C:G:T of each other sample, joined by commas; null is '.'."""
    return F.when(counts.isNull(), ".").otherwise(F.array_join(F.transform(counts, lambda c: F.concat_ws(":", *[c[b].cast("string") for b in "ACGT"])), ","))


def as_text(rows: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """Tab-separated gzipped text in global order; nulls are empty fields."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    rows.orderBy(*order).select(line.alias("value")).write.text(path, compression="gzip")


def as_text_unless_empty(rows: DataFrame, path: str, columns: list[str], order: list[str]) -> bool:
    """as_text, but nothing at all is written of an empty table; whether something was."""
    if rows.isEmpty():
        return False
    as_text(rows, path, columns, order)
    return True


def as_headed_text(rows: DataFrame, path: str, header: list[str], columns: list[str], order: list[str]) -> None:
    """The same with lines of a header before all rows."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    body = rows.select(line.alias("value"), F.lit(None).cast("int").alias("head"), *[F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order)])
    head = rows.sparkSession.createDataFrame(list(enumerate(header)), "head int, value string")
    keys = [f"o{k}" for k in range(len(order))]
    body.unionByName(head, allowMissingColumns=True).orderBy(F.col("head").asc_nulls_last(), *keys).select("value").write.text(path, compression="gzip")


def change_rows(changes: DataFrame) -> DataFrame:
    """The 12 columns of a change table, strands rendered; a collapsed read's molecule is its name."""
    molecule = F.col("qname") if "qname" in changes.columns else F.col("zm").cast("string")
    second = F.lit(".") if dict(changes.dtypes)["strand_2"] == "string" else rendered_strand(F.col("strand_2"))
    more = [F.col(c) for c in ("sample", "shared", "annotation", "counts") if c in changes.columns]
    return changes.select(
        "contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), molecule.alias("zm"), "tri", "ref", rendered_strand(F.col("strand_1")).alias("strand_1"), second.alias("strand_2"), "nob", "n_mis", "kind", "depth", *more
    )


def shared_rows(rows: DataFrame) -> DataFrame:
    """The 15 columns of a shared change table: change_rows with shared, annotation and counts ('.' where not computed)."""
    return change_rows(rows).withColumn("counts", rendered_counts(F.col("counts")) if "counts" in rows.columns else F.lit("."))


def report_lines(metrics: DataFrame) -> list[str]:
    """A readable report of a one-row table of counters."""
    row = metrics.first().asDict()
    width = max(map(len, row), default=0)
    return [f"{k:<{width}}  {v:,}" if isinstance(v, int) else f"{k:<{width}}  {v}" for k, v in row.items()]
