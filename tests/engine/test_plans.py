"""Plans and sinks that other tests only pass through."""

import os

import pytest
from pyspark.sql import functions as F

from strandweave.plans import preprocess, somatic
from strandweave.session import durable, small
from strandweave.sources import alignments, sinks

from .test_alignments import file  # noqa: F401
from .test_molecules import READS

O = preprocess.Options(min_qlen=0, min_depth=1)


def reads_of(spark, spans):
    return spark.createDataFrame([(s, c, a, 0, 60, [(0, b - a)], "A" * (b - a), [93] * (b - a), f"m/{k}/fwd", 0, 20.0, k, None, k) for k, (s, c, a, b) in enumerate(spans)], READS)


def test_masks_of_depth_and_low_complexity(spark):
    """20 reads on one place of a contig of 1,000 make it too deep: mean 1.5, cap 6.4."""
    spans = [("s", "c", 100, 150)] * 20 + [("s", "c", 300, 400)] * 5 + [("t", "c", 0, 50)]
    contigs = spark.createDataFrame([("c", 1000, 0)], "contig string, length long, idx int")
    reads = reads_of(spark, spans)
    high = preprocess.high_coverage(reads, contigs, O)
    assert [tuple(r) for r in high.select("sample", "contig", "start", "end").collect()] == [("s", "c", 100, 150)]
    low = spark.createDataFrame([("c", 150, 160), ("c", 90, 95), ("d", 1, 2)], "contig string, start long, end long")
    got = sorted(tuple(r) for r in preprocess.mask(reads, contigs, low, O).select("sample", "contig", "start", "end").collect())
    assert got == [("s", "c", 90, 95), ("s", "c", 100, 160), ("s", "d", 1, 2), ("t", "c", 90, 95), ("t", "c", 150, 160), ("t", "d", 1, 2)]
    assert [tuple(r) for r in preprocess.mask(reads, contigs, None, O).select("sample", "contig", "start", "end").collect()] == [("s", "c", 100, 150)]


def test_high_coverage_in_header_order(spark, file, tmp_path):  # noqa: F811
    header = alignments.header_contigs(spark, file[0])
    assert [tuple(r) for r in header.orderBy("idx").collect()] == [("a", 5_000_000, 0), ("b", 300_000, 1)]
    rows = spark.createDataFrame([("s", "z", 1, 2), ("s", "b", 5, 9), ("s", "a", 10, 11), ("s", "a", 9, 10)], "sample string, contig string, start long, end long")
    swapped = header.withColumn("idx", 1 - F.col("idx"))
    assert [r.contig for r in preprocess.ordered_high_coverage(rows, header).collect()] == ["a", "a", "b", "z"]
    assert [(r.contig, r.start) for r in preprocess.ordered_high_coverage(rows, swapped).collect()] == [("b", 5), ("a", 9), ("a", 10), ("z", 1)]
    assert not sinks.as_text_unless_empty(rows.where("false"), f"{tmp_path}/none", ["contig", "start", "end"], ["start"]) and not os.path.exists(f"{tmp_path}/none")
    assert sinks.as_text_unless_empty(rows, f"{tmp_path}/some", ["contig", "start", "end"], ["start"])
    assert [r.value for r in spark.read.text(f"{tmp_path}/some").collect()] == ["z\t1\t2", "b\t5\t9", "a\t9\t10", "a\t10\t11"]


def test_one_sample_alone(spark):
    changes = spark.createDataFrame([("s", "c", p, 1 + (p > 5), kind, "T", n) for p, kind, n in [(1, "x", 0), (2, "x", 1), (3, "m", 0), (4, "z", 0), (6, "x", 0), (7, "x", 0), (8, "x", 0)]], "sample string, contig string, pos int, zm long, kind string, alt string, n_mis int")
    context = spark.createDataFrame([("s", "c", p, 10) for p in range(20)], "sample string, contig string, start int, depth int")
    rows, rates = somatic.single_sample(changes, context, most=3)
    assert {r.pos: r.annotation for r in rows.collect()} == {1: "DNM", 2: "FPD", 3: "MSM", 4: "RDM", 6: "FPD", 7: "FPD", 8: "FPD"}
    (rate,) = rates.collect()
    assert (rate.tot_muts, rate.tot_bps) == (1, 200) and rate.mut_rate == 1 / 200 and rate.poisson_ci_lo < rate.mut_rate < rate.poisson_ci_hi


def test_tables_for_every_task_are_counted(spark):
    assert small(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError, match="more than 4"):
        small(spark.range(5), 4)
    kept = durable(spark.range(7))
    assert kept.count() == 7 and "LogicalRDD" in kept._jdf.queryExecution().analyzed().toString()
