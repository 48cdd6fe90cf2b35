"""Molecules walked as arrays against the same told by columns, a row a base."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.operators import kmers, molecules, walk
from strandweave.plans import preprocess

READS = "sample string, contig string, pos int, flag int, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual array<int>, qname string, nm int, ec double, zm bigint, sm array<int>, input_ord bigint"


def random_read(rng, genome, contig, zm, side, ordinal, near=None, sample="s1"):
    """A read with a random CIGAR, mostly like the reference."""
    at = max(0, min(len(genome) - 30, (rng.randrange(len(genome)) if near is None else near + rng.randint(-9, 9))))
    cigar, seq, r = [], [], at
    if rng.random() < 0.3:
        n = rng.randint(1, 5)
        cigar.append((4, n))
        seq += rng.choices("ACGT", k=n)
    while len(seq) < 60 and r < len(genome) - 12:
        op = rng.choice([0, 7, 8, 0, 7, 1, 2, 3])
        n = rng.randint(1, 12)
        if op in (0, 7, 8):
            seq += [c if rng.random() < 0.97 else rng.choice("ACGTN") for c in genome[r : r + n]]
            r += n
        elif op == 1:
            seq += rng.choices("ACGT", k=n)
        else:
            r += n
        cigar.append((op, n))
    qual = [rng.choice([93, 93, 93, 40, 0]) for _ in seq]
    return (sample, contig, at, 0, 60, cigar, "".join(seq), qual, f"m/{zm}/{side}", rng.randint(0, 4), 20.0 + zm, zm, [rng.randint(0, 9) for _ in seq] if rng.random() < 0.7 else None, ordinal)


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    genomes = {"a": "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=700)), "b": "".join(rng.choices("ACGTacgt", k=130)), "c": "AC"}
    rows = []
    for zm in range(90):
        contig = rng.choice("aaab")
        near = rng.randrange(len(genomes[contig]))
        own = "".join(c if rng.random() < 0.96 else rng.choice("ACGT") for c in genomes[contig].upper())  # changes of both strands
        for side in rng.choice([("fwd", "rev"), ("rev", "fwd"), ("fwd",), ("fwd", "fwd", "rev", "rev"), ("fwd", "rev", "fwd", "rev")]):
            rows.append(random_read(rng, own, contig, zm, side, len(rows), near, rng.choice(["s1"] * 9 + ["s2"])))
    # edges of a contig, and beyond it
    for k, (at, n) in enumerate([(0, 20), (110, 20), (120, 20), (140, 5)]):
        body = (genomes["b"].upper() + "ACGTACGTACGTACGTACGTACGTACGT")[at : at + n]
        rows += [("s1", "b", at, 0, 60, [(0, n)], body, [93] * n, f"m/{900 + k}/{s}", 0, 20.0, 900 + k, None, len(rows) + j) for j, s in enumerate(("fwd", "rev"))]
    rows = [(*r[:13], k) for k, r in enumerate(rows)]
    return spark.createDataFrame(rows, READS).repartition(3), spark.createDataFrame(list(genomes.items()), "contig string, seq string")


def same(one, two, columns):
    told = lambda df: sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert told(one) == told(two)


@pytest.mark.parametrize("collapsed,size", [(False, 16), (True, 1 << 14)])
def test_equal_to_the_walk_by_columns(spark, world, collapsed, size):
    reads, reference = world
    o = preprocess.Options(min_qlen=0, trim=3, indel_pad=1, mismatch_window=4, quality_window=5, min_identity=0.0, max_softclip=2.0, min_ec=0.0, min_bq=40, z_share=7, collapsed=collapsed)
    by_base, tiles = kmers.position_contexts(reference), molecules.reference_tiles(reference, size)
    called, found = preprocess.calls(reads, by_base, o).cache(), preprocess.walked(reads, tiles, o, size).cache()
    told, want = molecules.records(found), called.where("kind is not null")
    names = sorted(set(want.columns) - {"input_ord"})
    assert sorted(told.columns) == names and want.select("kind").distinct().count() == (2 if collapsed else 3)
    same(told, want, names)
    same(molecules.qualities(found), called.where("base = ref").groupBy("bq").agg(F.count(F.lit(1)).alias("n")) if collapsed else walk.bq_histogram(called), ["bq", "n"])
    runs = found.select("sample", "contig", "zm", F.explode("runs").alias("r")).select("sample", "contig", "zm", F.explode(F.sequence(F.col("r.start"), F.col("r.end") - 1)).alias("pos"))
    same(runs, called.where("callable"), ["sample", "contig", "zm", "pos"])
    assert found.agg(F.sum("n_callable")).first()[0] == called.where("callable").count()
    mask = spark.createDataFrame([("s1", "a", 100, 180), ("s1", "b", 0, 9)], "sample string, contig string, start int, end int")
    for least in (0, 2):
        deep = preprocess.Options(**{**o.__dict__, "min_depth": least})
        context = preprocess.context(called, by_base, mask, deep)
        assert least or context.count() > 100
        same(preprocess.context_of(found, tiles, mask, deep, size), context, ["sample", "contig", "start", "end", "tri", "depth"])
        changes = preprocess.changes(called, mask, deep)
        same(preprocess.changes_of(found, mask, deep), changes, sorted(changes.columns))
    contigs = spark.createDataFrame([("a", 700, 0), ("b", 130, 1), ("c", 2, 2)], "contig string, length long, idx int")
    one, two = (preprocess.metrics(reads, x, contigs, o) for x in (called, found))
    same(one, two, one.columns)
    raw = preprocess.raw_coverage(reads, contigs, o)
    one, two = (preprocess.coverage_report(x, contigs, raw) for x in (called, found))
    same(one, two, one.columns)


def test_no_row_a_base_in_the_plan(spark, world):
    reads, reference = world
    o = preprocess.Options(min_qlen=0, min_identity=0.0, max_softclip=2.0, min_ec=0.0)
    found = preprocess.walked(reads, molecules.reference_tiles(reference), o)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "MapInArrow" in plan


def test_tiles_of_pieces_equal_tiles_of_contigs(spark, tmp_path):
    from strandweave.sources import tables

    rng = random.Random(2)
    bodies = {"a": "".join(rng.choices("acgtN", k=95)), "b": "ACGTACGT", "c": "A"}
    text, index, at = "", "", 0
    for name, body in bodies.items():
        lines = [body[k : k + 10] for k in range(0, len(body), 10)]
        index += f"{name}\t{len(body)}\t{len(text) + len(name) + 2}\t10\t11\n"
        text += f">{name}\n" + "\n".join(lines) + "\n"
    (tmp_path / "r.fa").write_text(text)
    (tmp_path / "r.fai").write_text(index)
    pieces = tables.sequence_chunks(spark, str(tmp_path / "r.fa"), str(tmp_path / "r.fai"), size=8)
    whole = spark.createDataFrame(list(bodies.items()), "contig string, seq string")
    one, two = molecules.reference_tiles(pieces, 8), molecules.reference_tiles(whole, 8)
    same(one, two, ["contig", "tile", "lead", "seq", "length"])
    with pytest.raises(Exception, match="another size"):
        molecules.reference_tiles(pieces, 5).collect()


def test_arrays_of_a_read_equal_its_columns(spark):
    rng = random.Random(5)
    genome = "".join(rng.choices("ACGT", k=400))
    rows = [random_read(rng, genome, "a", k, "fwd", k) for k in range(60)]
    reads = spark.createDataFrame(rows, READS)
    for trim, pad in ((0, 0), (3, 2), (0.1, 5), (0.001, 1), (100, 0)):
        want = {r.zm: r.q for r in reads.select("zm", walk.masked_qualities(F.col("qual"), walk.placed_ops(F.col("cigar")), trim, pad).alias("q")).collect()}
        for r in rows:
            op, n = (np.array(x) for x in zip(*r[5], strict=True))
            assert molecules.masked(np.array(r[7]), op, n, trim, pad).tolist() == want[r[11]]


def test_long_reads_take_little_time(spark):
    """1,000 reads of 10,000 bases; the walk by columns takes over 20 times as long on a sample of them."""
    rng = random.Random(6)
    genome = "".join(rng.choices("ACGT", k=30_000))
    rows = []
    for zm in range(500):
        at = rng.randrange(20_000)
        rows += [("s", "a", at, 0, 60, [(0, 5000), (1, 2), (0, 4998)], genome[at : at + 5000] + "AC" + genome[at + 5000 : at + 9998], [93] * 10_000, f"m/{zm}/{s}", 2, 20.0, zm, None, 2 * zm + k) for k, s in enumerate(("fwd", "rev"))]
    reads = spark.createDataFrame(rows, READS).repartition(8).cache()
    reads.count()
    reference = spark.createDataFrame([("a", genome)], "contig string, seq string")
    o = preprocess.Options()
    timed = lambda df: (time.time(), df.agg(F.count(F.lit(1))).collect(), time.time())
    a = timed(preprocess.walked(reads, molecules.reference_tiles(reference), o).select("n_callable"))
    few = reads.where("zm < 10")
    b = timed(preprocess.calls(few, kmers.position_contexts(reference), o).where("callable").select("bq_mean_1", "bq_sd_1", "bq_mean_2"))
    assert a[2] - a[0] < 25 * (b[2] - b[0])
    reads.unpersist()
