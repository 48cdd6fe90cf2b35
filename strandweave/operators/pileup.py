"""Allele counts of reads at chosen sites."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.dna import BASES
from ..session import small
from .filters import pileup_read
from .intervals import binned, range_join
from .walk import BLOCK_OPS, REFERENCE_OPS, placed_ops

#: Sites a position from which on a tile is dense: at some 10,000 bases a read, 400 sites a read.
DENSE_SHARE = 0.04


def read_spans(reads: DataFrame, min_mapq: int = 30) -> DataFrame:
    """Usable reads with start and end on the reference (null for none: one base)."""
    span = F.aggregate(F.filter("cigar", lambda o: o["op"].isin(*REFERENCE_OPS)), F.lit(0), lambda t, o: t + o["len"])
    return reads.where(pileup_read(min_mapq)).withColumn("__ops", placed_ops(F.col("cigar"))).withColumn("start", F.col("pos")).withColumn("end", F.col("pos") + F.greatest(span, F.lit(1))).drop("pos")


def count_alleles(reads: DataFrame, sites: DataFrame, min_mapq: int = 30, min_baseq: int = 70, bin_width: int = 16_384, dense_share: float = DENSE_SHARE) -> DataFrame:
    """sample, contig, pos, A, C, G, T for the sites (sample, contig, pos) that reads of that sample cover.

    Deleted and skipped bases, and other letters, count for none. In tiles of
    bin_width where sites are at least dense_share of all positions, reads are counted into
    arrays of all the tile's positions; elsewhere each site meets its reads. Both give equal rows.
    """
    spans = read_spans(reads, min_mapq).select("sample", "contig", "start", "end", "__ops", "seq", "qual")
    distinct = sites.select("sample", "contig", "pos").distinct().withColumn("tile", F.floor(F.col("pos") / bin_width))
    tiles = distinct.groupBy("sample", "contig", "tile").agg((F.count(F.lit(1)) >= dense_share * bin_width).alias("dense"))
    told = distinct.join(tiles, ["sample", "contig", "tile"])
    few = sparse_counts(spans, told.where("not dense").select("sample", "contig", "pos"), min_baseq, bin_width)
    many = tile_counts(spans, tiles.where("dense").select("sample", "contig", "tile"), min_baseq, bin_width)
    return few.unionByName(many.join(told.where("dense").select("sample", "contig", "pos"), ["sample", "contig", "pos"], "left_semi"))


def tile_counts(spans: DataFrame, tiles: DataFrame, min_baseq: int, bin_width: int, most_tiles: int = 64) -> DataFrame:
    """sample, contig, pos, A, C, G, T of all covered positions of some tiles (sample, contig, tile).

    A task adds its reads up in one array a tile, a bounded number of them at a time, and sends on
    the positions it has counts for; those of all tasks are summed.
    """
    binned_reads = binned(spans.withColumn("ops", F.transform("__ops", lambda o: F.array(o["op"], o["len"], o["r"], o["q"]))), bin_width).withColumnRenamed("__bin", "tile")
    met = binned_reads.join(tiles, ["sample", "contig", "tile"]).select("sample", "contig", "tile", "start", F.flatten("ops").alias("ops"), "seq", "qual")
    letters = np.full(256, 4, np.int64)
    letters[list(BASES.encode())] = range(4)
    kinds = {c: spans.schema[c].dataType.simpleString() for c in ("sample", "contig")}

    def told(held: dict) -> Iterator[pa.RecordBatch]:
        for (sample, contig, tile), counts in held.items():
            at = np.flatnonzero(counts.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array([sample] * len(at), pa.string()), pa.array([contig] * len(at), pa.string()), pa.array(at + tile * bin_width), *(pa.array(counts[at, k]) for k in range(4))], names=["sample", "contig", "pos", *BASES])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for row in range(len(batch)):
                sample, contig, tile, start = (batch.column(c)[row].as_py() for c in ("sample", "contig", "tile", "start"))
                op, n, r, q = batch.column("ops")[row].values.to_numpy(zero_copy_only=False).reshape(-1, 4).T.astype(np.int64)
                block = np.isin(op, BLOCK_OPS) & (n > 0)
                n, r, q = n[block], r[block], q[block]
                k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at, place = np.repeat(r, n) + k + start - tile * bin_width, np.repeat(q, n) + k
                base = letters[np.frombuffer(batch.column("seq")[row].as_py().encode(), np.uint8)[place]]
                good = (at >= 0) & (at < bin_width) & (base < 4) & (batch.column("qual")[row].values.to_numpy(zero_copy_only=False)[place] >= min_baseq)
                if (sample, contig, tile) not in held and len(held) >= most_tiles:
                    yield from told(held)
                counts = held.setdefault((sample, contig, tile), np.zeros((bin_width, 4), np.int64))
                counts[at[good], base[good]] += 1  # a read has each position once
        yield from told(held)

    parts = met.mapInArrow(run, f"sample {kinds['sample']}, contig {kinds['contig']}, pos long, {', '.join(f'{b} long' for b in BASES)}")
    return parts.groupBy("sample", "contig", "pos").agg(*[F.sum(b).alias(b) for b in BASES])


def sparse_counts(spans: DataFrame, sites: DataFrame, min_baseq: int, bin_width: int) -> DataFrame:
    """sample, contig, pos, A, C, G, T: every site meets the reads over it."""
    met = range_join(sites, spans, ["sample", "contig"], "pos", "start", "end", bin_width)
    offset = F.col("pos") - F.col("start")
    block = F.element_at(F.filter("__ops", lambda o: o["op"].isin(*BLOCK_OPS) & (offset >= o["r"]) & (offset < o["r"] + o["len"])), 1)
    seen = met.withColumn("__o", F.when(F.size(F.filter("__ops", lambda o: o["op"].isin(*BLOCK_OPS) & (offset >= o["r"]) & (offset < o["r"] + o["len"]))) > 0, block))
    seen = seen.withColumn("__q", F.col("__o.q") + offset - F.col("__o.r")).where("__q is not null")
    seen = seen.withColumn("base", F.substring("seq", F.col("__q") + 1, F.lit(1))).withColumn("bq", F.element_at("qual", (F.col("__q") + 1).cast("int")))
    good = seen.where((F.col("bq") >= min_baseq) & F.col("base").isin(*BASES))
    return good.groupBy("sample", "contig", "pos").agg(*[F.count_if(F.col("base") == b).alias(b) for b in BASES])


def sites_of_others(candidates: DataFrame, samples: DataFrame) -> DataFrame:
    """For each sample, the sites (contig, pos) of all other samples' candidates.

    samples: one row to a sample; it is counted, and goes to every task.
    """
    other = small(samples.select(F.col("sample").alias("bam")))
    sites = candidates.select("sample", "contig", "pos").distinct()
    return sites.join(other, F.col("bam") != F.col("sample")).select(F.col("bam").alias("sample"), "contig", "pos").distinct()


def support(candidates: DataFrame, counts: DataFrame, samples: DataFrame, min_alt_support: int = 1) -> DataFrame:
    """sample, contig, pos, alt, n_support, counts: other samples whose reads hold the changed base often enough.

    counts lists A, C, G, T of every other sample in the order of samples.ord; missing ones are zeros.
    """
    least = max(1, min_alt_support)
    others = small(samples.select(F.col("sample").alias("bam"), "ord"))
    keys = candidates.select("sample", "contig", "pos", "alt").distinct().join(others, F.col("bam") != F.col("sample"))
    met = keys.join(counts.withColumnRenamed("sample", "bam"), ["bam", "contig", "pos"], "left").na.fill(0, list(BASES))
    of_alt = F.coalesce(*[F.when(F.col("alt") == b, F.col(b)) for b in BASES], F.lit(0))
    listed = F.sort_array(F.collect_list(F.struct("ord", *BASES)))
    grouped = met.groupBy("sample", "contig", "pos", "alt").agg(F.count_if(of_alt >= least).alias("n_support"), listed.alias("counts"))
    return grouped.withColumn("counts", F.transform("counts", lambda c: F.struct(*[c[b].alias(b) for b in BASES])))
