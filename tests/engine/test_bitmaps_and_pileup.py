import random

import pytest
from pyspark.sql import functions as F

from strandweave.operators import bitmaps, pileup, setops

from .test_molecules import READS, random_read


def test_shared_positions_equal_the_grouped_ones(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), rng.choice(["a", "a", "b"]), rng.choice([0, 7, 8, 32_767, 32_768, 65_535, 65_536, rng.randint(0, 60)])) for _ in range(900)] + [("x", "c", 5), (None, "a", 1), ("x", None, 1), ("y", "a", None)]
    table = spark.createDataFrame(rows, "sample string, contig string, pos long")
    known = table.where("sample is not null and contig is not null and pos is not null")
    want = {(r.contig, r.pos) for r in setops.shared_space(known, "sample", ["contig", "pos"]).collect()}
    found = bitmaps.shared_positions(table, "sample", ["contig"])
    assert {(r.contig, r.pos) for r in bitmaps.positions(found, ["contig"]).collect()} == want and len(want) > 10
    kept = sorted(((s, c, p) for s, c, p in rows if (c, p) in want), key=str)
    for most in (bitmaps.BROADCAST_PAGES, 0):
        assert sorted((tuple(r) for r in bitmaps.holding(table, found, ["contig"], most_pages=most).collect()), key=str) == kept
    every = bitmaps.union(bitmaps.pages(known, ["contig"]), ["contig"])
    assert {(r.contig, r.pos) for r in bitmaps.positions(every, ["contig"]).collect()} == {(c, p) for s, c, p in rows if s and c and p is not None}
    assert bitmaps.positions(bitmaps.shared_positions(table.where("false"), "sample", ["contig"]), ["contig"]).count() == 0


def test_pages_shuffle_and_rows_stay(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.concat(F.lit("s"), F.col("id") % 3).alias("sample"), F.lit("c").alias("contig"), F.floor(F.col("id") / 3).alias("pos"))
    found = bitmaps.shared_positions(rows, "sample", ["contig"])
    assert found.count() == 5 and found.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 133_333
    plan = bitmaps.holding(rows, found, ["contig"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("share", [0.0, 0.04, 2.0])
def test_dense_and_sparse_pileups_are_equal(spark, share):
    """All tiles dense, each as it is, none dense: against a loop over the reads."""
    rng = random.Random(8)
    genome = "".join(rng.choices("ACGTN", k=600))
    rows = [random_read(rng, genome, rng.choice("ab"), k, "fwd", k, sample=rng.choice("st")) for k in range(120)]
    sites = {(s, c, rng.randrange(600) if c == "a" else rng.randrange(0, 600, 40)) for s in "st" for c in "ab" for _ in range(300)}
    want = {}
    for sample, contig, at, _, _, cigar, seq, qual, *_ in rows:
        r, q = at, 0
        for op, n in cigar:
            if op in (0, 7, 8):
                for k in range(n):
                    if (sample, contig, r + k) in sites and qual[q + k] >= 40 and seq[q + k] in "ACGT":
                        want.setdefault((sample, contig, r + k), [0, 0, 0, 0])["ACGT".index(seq[q + k])] += 1
            r += n if op in (0, 2, 3, 7, 8) else 0
            q += n if op in (0, 1, 4, 7, 8) else 0
    got = pileup.count_alleles(spark.createDataFrame(rows, READS).repartition(3), spark.createDataFrame(sorted(sites), "sample string, contig string, pos long"), 30, 40, bin_width=64, dense_share=share)
    assert {tuple(r)[:3]: list(tuple(r)[3:]) for r in got.collect()} == want and got.count() == len(want)


def test_many_tiles_in_few_arrays(spark):
    rng = random.Random(9)
    genome = "".join(rng.choices("ACGT", k=600))
    reads = spark.createDataFrame([random_read(rng, genome, "a", k, "fwd", k) for k in range(60)], READS)
    spans = pileup.read_spans(reads).select("sample", "contig", "start", "end", "__ops", "seq", "qual")
    tiles = spark.range(40).select(F.lit("s1").alias("sample"), F.lit("a").alias("contig"), F.col("id").alias("tile"))
    told = lambda most: sorted(tuple(r) for r in pileup.tile_counts(spans, tiles, 40, 16, most).collect())
    assert told(1) == told(64) and len(told(64)) > 300


def test_thin_positions_meet_as_words(spark):
    """A position in 40,000: no shuffle carries pages, and words are dealt out by the number of rows."""
    rng = random.Random(12)
    rows = [(rng.choice("xy"), rng.choice([1, 2, None]), rng.choice([k * 40_000 + k % 70 for k in range(150)] + [63, 64, 127, -1, None])) for _ in range(900)] + [(None, 1, 63)]
    table = spark.createDataFrame(rows, "sample string, contig long, pos long")
    known = table.where("sample is not null and contig is not null and pos >= 0")
    want = {(r.contig, r.pos) for r in setops.shared_space(known, "sample", ["contig", "pos"]).collect()}
    kept = sorted((r for r in rows if (r[1], r[2]) in want), key=str)
    for tasks in (None, 7):
        found = bitmaps.shared_words(table, "sample", ["contig"], tasks=tasks)
        held = bitmaps.holding_words(table, found, ["contig"], tasks=tasks)
        assert sorted((tuple(r) for r in held.collect()), key=str) == kept and len(want) > 10
        assert "bitmap_construct_agg" not in held._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(contig" in held._jdf.queryExecution().executedPlan().toString() and ", 7), REPARTITION_BY_NUM" in held._jdf.queryExecution().executedPlan().toString()
