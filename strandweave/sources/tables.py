"""Text tables: interval files, change tables, context tables, groups, spectra, indexes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

CONTEXT_SCHEMA = "contig string, start long, end long, tri string, depth long"
CHANGE_COLUMNS = "contig start end zm tri ref strand_1 strand_2 nob n_mis kind depth".split()
SHARED_COLUMNS = [*CHANGE_COLUMNS, "shared", "annotation", "counts"]


def _lines(spark: SparkSession, path) -> DataFrame:
    """Data lines of plain or gzipped text, without comments and track lines; \\r\\n is fine."""
    text = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), _decoded("_metadata.file_path").alias("path"))
    return text.where("length(line) > 0 and not line rlike '^(#|track|browser)'")


def _decoded(path: str):
    """A file's path as it is named; Spark tells it as part of a URL, where a blank is %20 and a plus sign itself."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def _whole(field, what: str):
    """A field of digits only as a long; anything else is an error."""
    return F.when(field.rlike("^[0-9]{1,18}$"), field.cast("long")).otherwise(F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(field, F.lit("null")))).cast("long"))


def sample_of(path):
    """A file's sample: its name up to the first dot."""
    return F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)


def intervals(spark: SparkSession, path, contigs: list[str] | None = None) -> DataFrame:
    """contig, start, end of an interval file. Fewer than 3 fields, and starts after ends, are errors; a file that isn't there has no intervals."""
    try:
        lines = _lines(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "contig string, start long, end long")
    parts = lines.select(F.split("line", "\t").alias("p"), "line")
    short = F.when(F.size("p") < 3, F.raise_error(F.concat(F.lit("fewer than 3 fields: "), "line")).cast("string")).otherwise(F.get("p", F.lit(0)))
    rows = parts.select(short.alias("contig"), _whole(F.get("p", F.lit(1)), "start").alias("start"), _whole(F.get("p", F.lit(2)), "end").alias("end"))
    rows = rows.withColumn("end", F.when(F.col("end") >= F.col("start"), F.col("end")).otherwise(F.raise_error(F.lit("interval ends before it starts")).cast("long")))
    return rows.where(F.col("contig").isin(*contigs)) if contigs is not None else rows


def contexts(spark: SparkSession, path) -> DataFrame:
    """sample, contig, start, end, tri, depth; exactly 5 fields."""
    parts = _lines(spark, path).select(sample_of("path").alias("sample"), F.split("line", "\t").alias("p"))
    five = F.when(F.size("p") == 5, F.col("p")).otherwise(F.raise_error(F.lit("a context line has 5 fields")).cast("array<string>"))
    p = parts.select("sample", five.alias("p"))
    return p.select("sample", F.col("p")[0].alias("contig"), _whole(F.col("p")[1], "start").alias("start"), _whole(F.col("p")[2], "end").alias("end"), F.col("p")[3].alias("tri"), _whole(F.col("p")[4], "depth").alias("depth"))


def changes(spark: SparkSession, path) -> DataFrame:
    """sample, the fields of a change table, alt (strand_1 up to its first colon) and the line itself."""
    parts = _lines(spark, path).select(sample_of("path").alias("sample"), "line", F.split("line", "\t").alias("p"))
    names = SHARED_COLUMNS
    rows = parts.select("sample", "line", *[F.get("p", F.lit(k)).alias(n) for k, n in enumerate(names)])
    numbers = {n: _whole(F.col(n), n) for n in ("start", "end")} | {n: F.col(n).cast("long") for n in ("nob", "n_mis")}
    return rows.withColumns(numbers).withColumn("kind", F.rtrim("kind")).withColumn("depth", F.expr("try_cast(depth as long)")).withColumn("alt", F.substring_index("strand_1", ":", 1)).withColumn("pos", F.col("start"))


def is_collapsed(spark: SparkSession, path) -> bool:
    """Whether a change table's header says that reads stand for both strands."""
    return not spark.read.text(path).where("value like '#%read_mode=collapsed%'").isEmpty()


def sequence_index(spark: SparkSession, path) -> DataFrame:
    """contig, length, idx from an index of sequences, in file order (a small file)."""
    rows = spark.read.csv(path, sep="\t", schema="contig string, length long, offset long, linebases int, linewidth int")
    ordered = rows.orderBy("offset").collect()  # a reference has a bounded number of sequences
    return spark.createDataFrame([(r.contig, r.length, k) for k, r in enumerate(ordered)], "contig string, length long, idx int")


def sequence_chunks(spark: SparkSession, path: str, index_path: str, size: int = 1 << 16, chunks_a_task: int = 64) -> DataFrame:
    """contig, start, lead, tail, seq (upper case): an uncompressed sequence file in pieces of `size` bases.

    seq begins with `lead` bases (0 to 2) of the piece before and ends with `tail` (0 or 1) of the
    next; start is where the piece's own bases begin. Tasks read their byte ranges, told by the
    index, from a file system that every executor sees; no task holds a whole contig.
    """
    if size < 2:
        raise ValueError("a piece has at least two bases")
    index = spark.read.csv(index_path, sep="\t", schema="contig string, length long, offset long, linebases int, linewidth int")
    total = index.agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 0
    pieces = index.where("length > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"))
    pieces = pieces.withColumn("lead", F.least(F.col("start"), F.lit(2)).cast("int")).withColumn("tail", (F.col("start") + size < F.col("length")).cast("int"))
    first, last = F.col("start") - F.col("lead"), F.least(F.col("start") + size, F.col("length")) + F.col("tail")
    byte = lambda base: F.col("offset") + F.floor(base / F.col("linebases")) * F.col("linewidth") + base % F.col("linebases")
    ranges = pieces.select("contig", "start", "lead", "tail", byte(first).cast("long").alias("at"), (byte(last - 1) + 1).cast("long").alias("to"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        with system.open_input_file(name) as f:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    at, to = row.column("at")[0].as_py(), row.column("to")[0].as_py()
                    seq = f.read_at(to - at, at).translate(None, b"\r\n").upper().decode("ascii")
                    yield pa.RecordBatch.from_arrays([*row.columns[:4], pa.array([seq])], names=["contig", "start", "lead", "tail", "seq"])

    return ranges.repartition(max(1, -(-int(total) // chunks_a_task)), "contig", "start").mapInArrow(read, "contig string, start long, lead int, tail int, seq string")


def manifest(spark: SparkSession, changes: list[str], alignments: list[str] | None = None) -> DataFrame:
    """sample, ord, changes, alignments: the files of a run's samples, in order.

    Files named twice count once, where they came first. Alignment files match change files in number and order; without them the column is null.
    """
    if alignments is not None and len(alignments) != len(changes):
        raise ValueError(f"{len(alignments)} alignment files for {len(changes)} change tables")
    partner: dict[str, str | None] = {}
    for table, alignment in zip(changes, alignments or [None] * len(changes), strict=True):
        if partner.setdefault(table, alignment) != alignment:
            raise ValueError(f"two alignment files for {table}")
    rows = spark.createDataFrame([(k, table, alignment) for k, (table, alignment) in enumerate(partner.items())], "ord int, changes string, alignments string")
    return rows.select(sample_of("changes").alias("sample"), "ord", "changes", "alignments")


def groups(spark: SparkSession, path, samples: DataFrame) -> DataFrame:
    """sample, group for every sample; if no line has a third column, all are in 'all'. Otherwise a sample without a group is an error."""
    rows = _lines(spark, path).select(F.split("line", "\t").alias("p"))
    every = samples.select("sample").distinct()
    if rows.where(F.size("p") >= 3).isEmpty():
        return every.withColumn("group", F.lit("all"))
    named = rows.select(F.trim(F.get("p", F.lit(1))).alias("sample"), F.nullif(F.trim(F.get("p", F.lit(2))), F.lit("")).alias("group")).distinct()
    missing = F.raise_error(F.concat(F.lit("no group for sample "), F.col("sample"))).cast("string")
    return every.join(named, "sample", "left").withColumn("group", F.when(F.col("group").isNotNull(), F.col("group")).otherwise(missing))


def spectra(spark: SparkSession, paths, column: str = "normcounts") -> DataFrame:
    """sample, sbs96, value: one column of spectrum tables with a header. Missing types and values are errors."""
    from ..functions.dna import substitutions

    rows = spark.read.csv(paths, sep="\t", header=True, comment="#").select(sample_of(_decoded("_metadata.file_path")).alias("sample"), "sbs96", F.col(column).cast("double").alias("value"))
    whole = rows.select("sample").distinct().crossJoin(F.broadcast(substitutions(spark).select("sbs96", "fit_ord")))  # 96 rows
    once = rows.groupBy("sample", "sbs96").agg(F.count(F.lit(1)).alias("n"), F.first("value").alias("value"))
    joined = whole.join(once, ["sample", "sbs96"], "left")
    bad = F.raise_error(F.concat_ws(" ", F.lit("missing or repeated"), "sample", "sbs96")).cast("double")
    return joined.select("sample", "sbs96", F.col("fit_ord").alias("ord"), F.when((F.col("n") == 1) & F.col("value").isNotNull(), F.col("value")).otherwise(bad).alias("value"))


def signatures(spark: SparkSession, path) -> DataFrame:
    """signature, ord, weight from a table of 96 types by signatures."""
    from ..functions.dna import substitutions

    wide = spark.read.csv(path, sep="\t", header=True)
    first, *names = wide.columns
    long = wide.select(F.col(f"`{first}`").alias("sbs96"), F.explode(F.array(*[F.struct(F.lit(n).alias("signature"), F.col(f"`{n}`").cast("double").alias("weight")) for n in names])).alias("s"))
    return long.select("sbs96", "s.*").join(F.broadcast(substitutions(spark).select("sbs96", F.col("fit_ord").alias("ord"))), "sbs96").select("signature", "ord", "weight")


def sequences(spark: SparkSession, path) -> DataFrame:
    """contig, seq (upper case) of a sequence file: records begin with '>'."""
    records = spark.read.text(path, lineSep=">").where("trim(value) <> ''")
    head = F.substring_index("value", "\n", 1)
    body = F.substring("value", F.length(head) + 2, F.length("value"))
    return records.select(F.regexp_extract(head, r"^(\S+)", 1).alias("contig"), F.upper(F.regexp_replace(body, r"\s", "")).alias("seq"))
