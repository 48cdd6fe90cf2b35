import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.functions import dna, stats
from strandweave.operators import annotate, attribution, intervals, kmers, pileup, setops, spectrum


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("tri,want", [("AGT", "ACT"), ("ACT", "ACT"), ("ANT", None), ("act", None), ("AC", None)])
def test_fold(spark, tri, want):
    assert one(spark, dna.fold(F.lit(tri))) == want


def test_substitution(spark):
    assert one(spark, dna.substitution(F.lit("G"), F.lit("T"), F.lit("AGT"))) == "A[C>A]T"
    assert one(spark, dna.substitution(F.lit("C"), F.lit("C"), F.lit("ACT"))) is None
    rows = dna.substitutions(spark).orderBy("ord").collect()
    assert len(rows) == 96 and rows[0].sbs96 == "A[C>A]A" and rows[1].sbs96 == "A[C>G]A" and {r.fit_ord for r in rows} == set(range(96))
    assert [r.sbs96 for r in sorted(rows, key=lambda r: r.fit_ord)][:5] == ["A[C>A]A", "A[C>A]C", "A[C>A]G", "A[C>A]T", "C[C>A]A"]


@pytest.mark.parametrize("k,low,high", [(0, 0, 3.688879), (1, 0.025318, 5.571643), (5, 1.623486, 11.668332), (10, 4.795389, 18.390356), (100, 81.363991, 121.626794)])
def test_poisson_limits(k, low, high):
    assert stats.poisson_limits(k) == pytest.approx((low, high), abs=2e-6)


def chi_square_quantile(n, z):
    """Cornish-Fisher expansion; the first term left out is of order n ** -2."""
    return n + 2**0.5 * z * n**0.5 + 2 * (z**2 - 1) / 3 + (z**3 - 7 * z) / (9 * 2**0.5 * n**0.5) - (6 * z**4 + 14 * z**2 - 32) / (405 * n) + (9 * z**5 + 256 * z**3 - 433 * z) / (4860 * 2**0.5 * n**1.5)


@pytest.mark.parametrize("k", [4_500, 5_000, 100_000, 10_000_000])
def test_poisson_limits_of_many_events(k):
    z = 1.959963984540054
    want = chi_square_quantile(2 * k, -z) / 2, chi_square_quantile(2 * k + 2, z) / 2
    assert stats.poisson_limits(k) == pytest.approx(want, rel=1e-9)


def spans(spark, rows):
    return spark.createDataFrame(rows, "contig string, start long, end long")


def listed(df):
    return sorted((r.start, r.end) for r in df.collect())


def test_merge(spark):
    assert listed(intervals.merge(spans(spark, [("c", 0, 5), ("c", 5, 8), ("c", 10, 12)]))) == [(0, 8), (10, 12)]
    assert listed(intervals.merge(spans(spark, [("c", 7, 7)]))) == [(6, 8)]
    assert listed(intervals.merge(spans(spark, [("c", 0, 50), ("c", 3, 9), ("c", 40, 90)]), length=F.lit(60))) == [(0, 60)]
    assert listed(intervals.merge(spans(spark, []))) == []


def test_merge_and_sweep_agree_with_arrays(spark):
    rng = np.random.default_rng(3)
    rows = [("c", int(s), int(s + n)) for s, n in zip(rng.integers(0, 300, 80), rng.integers(1, 30, 80), strict=True)]
    depth = np.zeros(400, int)
    for _, s, e in rows:
        depth[s:e] += 1

    def runs(mask):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(int), [0]))))
        return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]

    table = spans(spark, rows)
    assert listed(intervals.merge(table)) == runs(depth > 0)
    assert listed(intervals.at_least(table, F.lit(5))) == runs(depth >= 5)
    points = spark.createDataFrame([("c", i) for i in range(400)] + [("d", 5)], "contig string, pos long")
    free = intervals.unmasked(points, intervals.merge(table), bin_width=16).collect()
    assert {(r.contig, r.pos) for r in free} == {("c", i) for i in range(400) if not depth[i]} | {("d", 5)}


def test_cap(spark):
    assert [one(spark, intervals.depth_cap(F.lit(m), 1)) for m in (16.0, 0.0)] == [32.0, 2.0]


def test_sweep_of_two(spark):
    assert listed(intervals.at_least(spans(spark, [("c", 0, 10), ("c", 5, 15)]), F.lit(2))) == [(5, 10)]


def test_annotation_order(spark):
    rows = [("x", 1, 2, "GRM"), ("x", 0, 2, "FPD"), ("x", 0, 0, "DNM"), ("m", 0, 0, "MSM"), ("z", 0, 0, "RDM")]
    got = spark.createDataFrame(rows, "kind string, shared int, n_mis int, want string").withColumn("got", annotate.first_annotation(F.col("kind"), F.col("shared"), F.col("n_mis")))
    assert all(r.got == r.want for r in got.collect())
    crowded = spark.createDataFrame([("s", 1, "DNM")] * 5 + [("s", 2, "DNM")] * 4 + [("s", 1, "GRM")], "sample string, zm long, annotation string")
    told = annotate.flag_crowded(crowded, ["sample", "zm"], 5).groupBy("zm", "annotation").count().collect()
    assert {(r.zm, r.annotation): r["count"] for r in told} == {(1, "FPD"): 5, (2, "DNM"): 4, (1, "GRM"): 1}


def test_contig_choice(spark):
    fai = spark.createDataFrame([("b", 10, 0), ("a", 20, 1), ("c", 5, 2)], "contig string, length long, idx int")
    assert [r.contig for r in setops.chosen_contigs(fai, exclude=["a"]).collect()] == ["b", "c"]
    assert [r.contig for r in setops.chosen_contigs(fai, region=["c", "b"], exclude=["b"]).collect()] == ["b", "c"]
    with pytest.raises(ValueError):
        setops.chosen_contigs(fai, region=["x"])


def test_kmers(spark):
    seqs = spark.createDataFrame([("c1", "acGTNACA"), ("c2", "AC"), ("c3", "")], "contig string, seq string")
    got = {r.tri: r.n for r in kmers.completed(kmers.composition(seqs)).collect()}
    assert len(got) == 32 and {k: v for k, v in got.items() if v} == {"ACG": 2, "ACA": 1}
    assert kmers.composition(seqs, upper=False).collect() == [("ACA", 1)]
    placed = kmers.position_contexts(seqs).orderBy("contig", "pos").collect()
    assert [(r.pos, r.ref, r.tri) for r in placed][:3] == [(0, "A", None), (1, "C", "ACG"), (2, "G", "CGT")] and placed[7].tri is None and len(placed) == 10


def test_kmer_tally_agrees_with_exploded_rows(spark, monkeypatch):
    body = "".join(np.random.default_rng(2).choice(list("ACGTacgtNé "), 4000, p=[0.11] * 8 + [0.04] * 3))
    whole = kmers._codes(body.upper().encode())
    monkeypatch.setattr(kmers, "SLICE", 7)  # here only: the workers keep theirs
    assert whole.sum() > 1000 and (kmers._codes(body.upper().encode()) == whole).all()
    rows = spark.createDataFrame([(body, 3), (body[:50], None), ("ẗACG", 2), ("AC", 5), ("", 1), (None, 9)], "seq string, w int")
    slow = rows.select(F.coalesce("w", F.lit(0)).alias("depth"), F.explode(kmers.trimers(F.upper("seq"))).alias("tri"))
    want = {r.tri: (r.positions, r.total_depth) for r in spectrum.context_tally(slow).collect() if r.positions}
    assert {r.tri: (r.positions, r.total_depth) for r in kmers.tally(rows, "seq", "w").collect()} == want
    assert kmers.tally(rows.limit(0), "seq", "w").count() == 0
    assert sum(x[0] for x in want.values()) > 1000


def test_spectrum_of_unseen_contexts(spark):
    tally = kmers.completed(spark.createDataFrame([("ACA", 10)], "tri string, positions long"), "positions").withColumn("total_depth", F.col("positions") * 3)
    genome = spark.createDataFrame([("ACA", 4), ("ACC", 4)], "tri string, n long")
    changes = spark.createDataFrame([(1, "C", "A", "ACA"), (1, "C", "A", "ACA"), (2, "G", "T", "TGT"), (3, "C", "A", "ACC")], "pos long, ref string, alt string, tri string")
    rows = {r.sbs96: r for r in spectrum.normalise(spectrum.counts96(changes, ["pos", "ref", "alt"]), tally, genome).collect()}
    assert len(rows) == 96 and rows["A[C>A]A"].counts == 2 and rows["A[C>A]C"].counts == 1
    assert rows["A[C>A]A"].normcounts == pytest.approx(1.0) and rows["A[C>A]C"].normcounts == 0 and rows["A[C>A]A"].normcounts_frac == 1


def test_nnls_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = rng.random((20, 6)), rng.normal(size=20)
        x = attribution.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-7 and np.abs(slope[x > 0]).max(initial=0) < 1e-7


def test_attribution_recovers_a_mixture(spark):
    rng = np.random.default_rng(1)
    sig = rng.dirichlet(np.ones(96) * 0.3, size=3)
    weights = {"a": [3000, 0, 2000], "b": [2500, 0, 1500], "c": [4000, 0, 900]}
    signatures = spark.createDataFrame([(f"S{k}", i, float(sig[k, i])) for k in range(3) for i in range(96)], "signature string, ord int, weight double")
    spectra = spark.createDataFrame([(s, i, float(rng.poisson(np.dot(w, sig)[i]))) for s, w in weights.items() for i in range(96)], "sample string, ord int, value double")
    groups = spark.createDataFrame([(s, "g") for s in weights], "sample string, group string")
    found, final = attribution.attribute(spectra, signatures, groups, replicates=40)
    assert {r.signature for r in found.where("detected").collect()} == {"S0", "S2"}
    by = {(r["sample"], r.signature): r.exposure for r in final.collect()}
    assert len(by) == 6 and all(abs(by[s, f"S{k}"] - w[k]) < 0.1 * sum(w) for s, w in weights.items() for k in (0, 2))
    again = attribution.fit(spectra, signatures, 40, chunk=7)
    assert again.exceptAll(attribution.fit(spectra, signatures, 40)).isEmpty()


def test_pileup(spark):
    read = lambda sample, pos, seq, cigar, flag=0, bq=90: (sample, "c", pos, flag, 60, cigar, seq, [bq] * len(seq))
    reads = [read("t", 10, "ACGTA", [(0, 5)]), read("t", 8, "GGACT", [(4, 1), (0, 2), (2, 1), (0, 2)]), read("t", 10, "ACGTA", [(0, 5)], flag=2048), read("t", 10, "ACGTA", [(0, 5)], bq=10)]
    table = spark.createDataFrame(reads, "sample string, contig string, pos int, flag int, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual array<int>")
    sites = spark.createDataFrame([("t", "c", p) for p in (8, 10, 11, 14, 15)], "sample string, contig string, pos int")
    got = {r.pos: (r.A, r.C, r.G, r["T"]) for r in pileup.count_alleles(table, sites, bin_width=4).collect()}
    assert got == {8: (0, 0, 1, 0), 10: (1, 0, 0, 0), 11: (0, 2, 0, 0), 14: (1, 0, 0, 0)}
