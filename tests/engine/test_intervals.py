"""Two-level scans along contigs against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from strandweave.operators import intervals
from strandweave.session import tasks_for


def merged(spans):
    out = []
    for s, e in sorted((s - 1, e + 1) if s == e else (s, e) for s, e in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def steps(spans):
    change = {}
    for s, e in spans:
        change[s] = change.get(s, 0) + 1
        change[e] = change.get(e, 0) - 1
    places, depth, out = sorted(change), 0, []
    for k, p in enumerate(places):
        depth += change[p]
        out.append((p, places[k + 1] if k + 1 < len(places) else None, depth))
    return out


def spans(rng, n=400):
    """Half of all rows have one key; long spans reach over many bins, and gaps leave bins empty."""
    rows = []
    for _ in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", None])
        s = rng.choice([rng.randint(0, 300), rng.randint(2000, 2100), rng.randint(5000, 9000)])
        rows.append((key, s, s + rng.choice([0, 1, 3, 8, 8, rng.randint(0, 900) if rng.random() < 0.1 else 2])))
    return rows


@pytest.mark.parametrize("width", [16, 1 << 16])
def test_merge_and_sweep(spark, width):
    rows = spans(random.Random(width))
    table = spark.createDataFrame(rows, "contig string, start long, end long")
    keys = {k for k, _, _ in rows}
    got = [tuple(r) for r in intervals.merge(table, bin_width=width).select("contig", "start", "end").collect()]
    assert sorted(got, key=str) == sorted(((k, *x) for k in keys for x in merged([(s, e) for c, s, e in rows if c == k])), key=str)
    got = [tuple(r) for r in intervals.depth_steps(table, bin_width=width).select("contig", "pos", "next_pos", "depth").collect()]
    assert sorted(got, key=str) == sorted(((k, *x) for k in keys for x in steps([(s, e) for c, s, e in rows if c == k])), key=str)


def test_clipped_to_a_length_and_empty(spark):
    table = spark.createDataFrame([("c", -5, 3), ("c", 90, 200), ("c", 100, 100), ("d", 300, 400)], "contig string, start long, end long")
    assert sorted(tuple(r) for r in intervals.merge(table, length=F.lit(100), bin_width=10).select("contig", "start", "end").collect()) == [("c", 0, 3), ("c", 90, 100)]
    assert intervals.merge(table.where("false")).count() == 0 and intervals.depth_steps(table.where("false")).count() == 0


def test_one_contig_is_many_tasks(spark):
    """Windows over rows have the bin among their keys; only those over bins have not."""
    table = spark.range(0, 200_000, 1, 4).select(F.lit("c").alias("contig"), (F.col("id") * 7).alias("start"), (F.col("id") * 7 + 3).alias("end"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = intervals.merge(table, bin_width=1024)
        sizes = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 200_000 and max(sizes) < 60_000
    plan = intervals.depth_steps(table, bin_width=1024)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) >= 2 and any("__at" in line.rsplit("], [", 2)[-2] for line in windows)


def test_shuffles_grow_in_tasks(spark):
    """With a number of tasks every shuffle of rows has it, and nothing else changes; null keys stay keys, but for caps."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), s, s + rng.randint(0, 30)) for s in (rng.randint(0, 600) for _ in range(300))]
    table = spark.createDataFrame(rows, "contig string, start long, end long")
    told = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    scans = (
        lambda t: intervals.merge(table, bin_width=16, tasks=t),
        lambda t: intervals.depth_steps(table, bin_width=16, tasks=t),
        lambda t: intervals.at_least(table, F.lit(4), bin_width=16, tasks=t),
        lambda t: intervals.unmasked(table.withColumnRenamed("end", "pos").drop("start"), intervals.merge(table, bin_width=16), bin_width=16, tasks=t),
    )
    for scan in scans:
        assert told(scan(5)) == told(scan(None)) and len(told(scan(5))) > 3
    caps = table.select("contig").distinct().withColumn("cap", F.lit(4))
    assert told(intervals.at_least(table, caps, bin_width=16)) == told(scans[2](None))
    assert None in {r.contig for r in scans[0](5).collect()} and None not in {r.contig for r in scans[2](5).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = scans[0](5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles and all(", 5), " in x for x in shuffles), shuffles
    assert [tasks_for(spark.range(n)) for n in (0, 1 << 18, 40 << 18)] == [1, min(16, spark.sparkContext.defaultParallelism), 40]
