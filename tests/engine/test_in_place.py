"""Queries whose rows are dealt out once by key, and whose tasks add up before they send."""

import random

import numpy as np
from pyspark.sql import functions as F

from strandweave.operators import complexity, kmers, molecules, pairing, setops
from strandweave.plans.catalogue import QUERIES

from .test_molecules import READS, random_read

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotation_and_pairing_join_nothing(spark):
    for name in ("annotate_calls", "pair_strands_in_order"):
        assert "Join" not in plan(QUERIES[name](spark, SF)), name


def test_met_molecules_equal_the_joined_ones(spark):
    rng = random.Random(4)
    reads = spark.createDataFrame([(rng.randint(0, 30), rng.choice("fr"), k) for k in range(500)], "k int, side string, ord int")
    numbered = pairing.in_order(reads, ["k"], "side", "ord")
    told = lambda f: sorted(tuple(r) for r in f(numbered, ["k", "mol"], "side", "f", "r", ["ord"]).collect())
    assert told(pairing.met) == told(pairing.pair) and len(told(pairing.met)) > 100


def test_shared_in_one_pass_equals_the_joined_one(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(rng.choice(["a", "b", "c", None]), rng.choice([*range(60), None]), k) for k in range(200)], "sample string, key int, n int")
    known = rows.where("sample is not null and key is not null")
    want = setops.shared_with_others(known, setops.samples_holding(known, "sample", ["key"]), known, "sample", ["key"])
    told = lambda df: sorted(tuple(r) for r in df.select("sample", "key", "n", "shared").collect())
    assert told(setops.with_shared(rows, "sample", ["key"])) == told(want) and len({r[3] for r in told(want)}) == 3


def test_contexts_are_added_up_by_group_in_the_tasks(spark, monkeypatch):
    rng = random.Random(6)
    letters = "ACGTNacgté "
    rows = [(rng.choice(["x", "y", None]), rng.randint(0, 40), "".join(rng.choices(letters, k=rng.randint(0, 40))) or None, rng.choice([3, None])) for _ in range(300)]
    table = spark.createDataFrame(rows, "lang string, part int, text string, n int")
    slow = table.select("lang", "part", F.coalesce("n", F.lit(0)).alias("n"), F.explode(kmers.trimers(F.upper("text"))).alias("t")).withColumn("tri", kmers.fold(F.col("t"))).where("tri is not null")
    told = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    monkeypatch.setattr(kmers, "GROUPS", 7)
    for by in (("lang",), ("lang", "part")):
        got = kmers.tally(table, "text", "n", by=by)
        assert told(got) == told(slow.groupBy(*by, "tri").agg(F.count(F.lit(1)).alias("positions"), F.sum("n").cast("long").alias("total_depth"))) and got.count() > 40
    assert "Generate" not in plan(QUERIES["context_tally"](spark, SF))


def test_few_places_are_scored_whole():
    """Random letters with repeats here and there: the bound leaves little, and nothing that is in an interval."""
    rng = random.Random(7)
    text = "".join(rng.choices("ACGT", k=60_000))
    for k in range(0, 60_000, 9_000):
        text = text[:k] + "".join(rng.choices("ACGT", k=rng.randint(1, 5))) * 20 + text[k:]
    x = np.array(["ACGT".index(c) for c in text], np.uint8)
    code = x[:-2] * 25 + x[1:-1] * 5 + x[2:]
    everywhere = np.ones(len(code), bool)
    may = complexity._may_begin(code, code, complexity.WINDOW - 3, complexity.THRESHOLD)
    assert may.mean() < 0.1
    starts, ends = complexity._scored(code, code, ~everywhere, everywhere, complexity.WINDOW, complexity.THRESHOLD)
    got = complexity.perfect(np.frombuffer(text.encode(), np.uint8), len(text))
    assert np.array_equal(got[0], starts) and np.array_equal(got[1], ends) and len(starts) >= 7


def test_short_sequences_lie_end_to_end(spark, monkeypatch):
    """Neighbours in one pass, and one sequence over several, equal each by itself."""
    rng = random.Random(8)
    rows = [(k, rng.choice(["A" * rng.randint(0, 90), "".join(rng.choices("ACGT", k=rng.randint(0, 400))), "AC" * 150, "é" * 5 + "ACACAC" * 30])) for k in range(60)]
    table = spark.createDataFrame(rows, "id long, seq string")
    want = sorted((k, int(a), int(b)) for k, s in rows for a, b in zip(*complexity.perfect(np.frombuffer(s.encode("ascii", "replace"), np.uint8), len(s)), strict=True))
    for size in (1 << 18, 100):
        monkeypatch.setattr(complexity, "SLICE", size)
        assert sorted(tuple(r) for r in complexity.of_sequences(table, "id", "seq").select("id", "start", "end").collect()) == want and len(want) > 30


def test_reads_are_dealt_to_as_many_tasks_as_asked(spark):
    rng = random.Random(9)
    genome = "".join(rng.choices("ACGT", k=600))
    reads = spark.createDataFrame([random_read(rng, genome, "a", k // 2, "fwd" if k % 2 else "rev", k) for k in range(60)], READS)
    tiles = molecules.reference_tiles(spark.createDataFrame([("a", genome)], "contig string, seq string"), 64)
    one, two = (molecules.walked(reads, tiles, molecules.Rules(min_bq=1, trim=0), size=64, tasks=n) for n in (None, 5))
    told = lambda df: sorted((str(r) for r in df.collect()))
    assert told(one) == told(two) and len(told(two)) >= 5
    assert plan(two).count(", 5), REPARTITION_BY_NUM") >= 3


def test_a_molecule_is_paired_and_walked_along_one_sort_of_its_reads(spark):
    """Wide rows are dealt once and sorted once; their reads are laid out together, not one by one."""
    reads = spark.createDataFrame([(1, "F", 1, "x")], "k int, side string, ord int, body string")
    text = pairing.in_order(reads, ["k"], "side", "ord")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 1 and text.count("Exchange") == 1
    rng = random.Random(10)
    genome = "".join(rng.choices("ACGT", k=600))
    changed = "".join(c if rng.random() < 0.8 else rng.choice("ACGT") for c in genome)
    rows = [random_read(rng, changed, "a", k // 2, "fwd" if k % 2 else "rev", k, near=200) for k in range(40)]
    tiles = molecules.reference_tiles(spark.createDataFrame([("a", genome)], "contig string, seq string"), 64)
    rules = molecules.Rules(min_bq=1, trim=0)
    assert plan(molecules.walked(spark.createDataFrame(rows, READS), tiles, rules, size=64, tasks=5)).count(", 5), REPARTITION_BY_NUM") == 3
    wide = molecules.pairs(spark.createDataFrame(rows, READS)).selectExpr("*", "0L AS below_start", f"'{genome}' AS below", "600L AS length", "7L AS seed").toArrow().combine_chunks().to_batches()[0]
    whole = molecules.walked_rows(wide, ["_1", "_2"], rules)
    parts = list(molecules.slices(wide, ["_1", "_2"], 500))
    assert len(parts) > 3 and sum(map(len, whole[2].to_pylist())) > 10
    one_by_one = [molecules.walked_rows(x, ["_1", "_2"], rules) for x in parts]
    assert [x.to_pylist() for x in whole] == [[y for part in one_by_one for y in part[k].to_pylist()] for k in range(4)]
