"""3-mer composition of sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dna import BASES, contexts, fold

#: Letters that are counted at a time, so that a whole chromosome in one row takes little memory.
SLICE = 1 << 20


def trimers(seq: Column) -> Column:
    """All overlapping 3-mers of a sequence, in order: three slices of its characters, zipped."""
    chars = F.split(seq, "")
    n = F.length(seq)
    pairs = F.zip_with(chars, F.slice(chars, 2, F.greatest(n, F.lit(1))), lambda a, b: F.concat(a, b))
    triples = F.zip_with(pairs, F.slice(chars, 3, F.greatest(n, F.lit(1))), lambda a, b: F.concat(a, b))
    return F.when(n >= 3, F.slice(triples, 1, F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))


def _codes(body: bytes) -> np.ndarray:
    """How often each of the 64 3-mers occurs, in the order of BASES; windows with any other letter don't count."""
    known, out = np.full(256, 64, np.uint8), np.zeros(64, np.int64)
    known[list(BASES.encode())] = range(4)
    letters = np.frombuffer(body, np.uint8)
    for at in range(0, len(letters) - 2, SLICE):
        x = known[letters[at : at + SLICE + 2]].astype(np.int16)
        window = x[:-2] * 16 + x[1:-1] * 4 + x[2:]
        out += np.bincount(window[np.maximum(np.maximum(x[:-2], x[1:-1]), x[2:]) < 4], minlength=64)
    return out


#: Groups of which a task adds up 3-mers at a time.
GROUPS = 4096


def tally(rows: DataFrame, seq: str = "seq", weight: str | None = None, upper: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """by, tri, positions, total_depth: folded 3-mers of all rows and the sum of their rows' weights (nulls: 0).

    Each task adds up its own rows and sends on 64 numbers a group, whatever its size.
    """
    body = (F.upper(seq) if upper else F.col(seq)).cast("string")
    triples = [a + b + c for a in BASES for b in BASES for c in BASES]
    kinds = rows.select(*by).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            groups, n = list(sums), len(sums)
            positions, depth = (np.concatenate([sums[g][k] for g in groups]) for k in (0, 1))
            names = [pa.array([g[k] for g in groups], types[k]).take(pa.array(np.repeat(np.arange(n), 64))) for k in range(len(by))]
            return pa.RecordBatch.from_arrays([*names, pa.array(triples * n), pa.array(positions), pa.array(depth)], names=[*by, "tri", "positions", "total_depth"])

        for batch in batches:
            types = [batch.schema.field(2 + k).type for k in range(len(by))]
            groups = zip(*[batch.column(2 + k).to_pylist() for k in range(len(by))], strict=True) if by else [()] * len(batch)
            for text, w, group in zip(batch.column(0), batch.column(1).to_pylist(), groups, strict=True):
                if group not in sums:
                    if len(sums) >= GROUPS:
                        yield told()
                        sums.clear()
                    sums[group] = np.zeros((2, 64), np.int64)
                found = _codes((text.as_py() or "").encode("utf-8", "surrogatepass"))
                sums[group][0] += found
                sums[group][1] += found * w
        if sums:
            yield told()

    weighed = F.coalesce(F.col(weight).cast("long"), F.lit(0).cast("long")) if weight else F.lit(0).cast("long")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kinds], "tri string, positions long, total_depth long"])
    parts = rows.select(body.alias("__s"), weighed.alias("__w"), *by).mapInArrow(run, schema).where("positions > 0")
    return parts.groupBy(*by, fold(F.col("tri")).alias("tri")).agg(F.sum("positions").alias("positions"), F.sum("total_depth").alias("total_depth"))


def composition(sequences: DataFrame, seq: str = "seq", by: tuple[str, ...] = (), upper: bool = True) -> DataFrame:
    """by, tri, n: folded 3-mers by context. Others than A, C, G, T are left out; nothing reaches from one row to the next.

    upper: case doesn't count, as in genomes; without it lower-case letters are others.
    """
    return tally(sequences, seq, None, upper, by).select(*by, "tri", F.col("positions").alias("n"))


def chunk_composition(chunks: DataFrame, seq: str = "seq") -> DataFrame:
    """The same for a genome stored in chunks that repeat the 2 bases before them; the first of a contig has none before it.

    Bases of the next chunk at the end, told by a column tail, don't count again.
    """
    if "tail" in chunks.columns:
        chunks = chunks.withColumn(seq, F.expr(f"substring({seq}, 1, length({seq}) - tail)"))
    return composition(chunks, seq)


def completed(counts: DataFrame, value: str = "n") -> DataFrame:
    """All 32 contexts in order; absent ones have 0."""
    return contexts(counts.sparkSession).join(counts, "tri", "left").na.fill(0, [value])


def position_contexts(reference: DataFrame) -> DataFrame:
    """contig, pos, ref, tri from whole contigs (contig, seq), or from their pieces (`tables.sequence_chunks`): tri is null at a contig's edges."""
    if "lead" in reference.columns:
        inner = position_contexts(reference.select(F.struct("contig", "start", "lead", F.expr("length(seq) - tail").alias("end")).alias("contig"), "seq"))
        own = inner.where("pos >= contig.lead and pos < contig.end")
        return own.select("contig.contig", (F.col("contig.start") - F.col("contig.lead") + F.col("pos")).alias("pos"), "ref", "tri")
    seq = F.upper("seq")
    around = F.concat(F.array(F.lit(None).cast("string")), trimers(seq))
    rows = reference.where("length(seq) > 0").select("contig", F.posexplode(F.arrays_zip(F.split(seq, "").alias("ref"), around.alias("tri"))).alias("pos", "b"))
    return rows.select("contig", "pos", F.col("b.ref").alias("ref"), F.col("b.tri").alias("tri")).where("ref is not null")
