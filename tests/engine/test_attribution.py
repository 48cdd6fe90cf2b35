import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strandweave.operators import attribution, spectrum
from strandweave.sources import tables


def reference(rng, n=30, types=96):
    """n signatures, each with a few strong types."""
    a = rng.gamma(0.2, size=(types, n))
    return a / a.sum(axis=0)


def test_selection_recovers_planted_signatures():
    rng = np.random.default_rng(4)
    a = reference(rng)
    for _ in range(10):
        planted = np.sort(rng.choice(30, 3, replace=False))
        b = rng.poisson(a[:, planted] @ rng.uniform(2000, 6000, 3)).astype(float)
        x = attribution.selected(a, b, 0.02, 0.02)
        assert np.flatnonzero(x > 0).tolist() == planted.tolist()
        assert (attribution.nnls(a, b) > 0).sum() > 3
        for gain, loss in ((0.0, 0.0), (1.0, 1.0)):
            assert (attribution.selected(a, b, gain, loss) >= 0).all()
    assert not attribution.selected(a, np.zeros(96), 0.02, 0.02).any()


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(5)
    a = reference(rng, 8)
    mixes = {"p1": (0, 1), "p2": (0, 1), "p3": (0, 1), "q1": (2, 3, 4), "q2": (2, 3, 4), "r1": (5,)}
    spectra = [(s, k, float(v)) for s, own in mixes.items() for k, v in enumerate(rng.poisson(a[:, own].sum(axis=1) * 3000))]
    signatures = [(f"S{j}", k, float(a[k, j])) for j in range(8) for k in range(96)]
    groups = spark.createDataFrame([(s, s[0]) for s in mixes] + [("p1", "q")], "sample string, group string")
    return spark.createDataFrame(spectra, "sample string, ord int, value double"), spark.createDataFrame(signatures, "signature string, ord int, weight double"), groups


def test_second_tier_in_one_job_equals_a_fit_for_each_group(spark, world):
    """Groups with different signatures, a sample in two groups, a group that has none."""
    spectra, signatures, groups = world
    found, final = attribution.attribute(spectra, signatures, groups, replicates=20, min_samples=2, seed=9)
    summary = attribution.validated(found, groups, 2)
    kept = {}
    for r in summary.where("validated").collect():
        kept.setdefault(r.group, set()).add(r.signature)
    assert set(kept) == {"p", "q"} and kept["p"] != kept["q"]
    want = []
    for group, own in kept.items():
        part = attribution.fit(spectra.join(groups.where(F.col("group") == group), "sample"), signatures.where(F.col("signature").isin(*own)), 20, 10)
        want += [(r["sample"], group, r.signature, r.point, r.lo95, r.hi95) for r in attribution.intervals(part).collect()]
    assert sorted(tuple(r) for r in final.collect()) == sorted(want) and len(want) > 10
    lists = {r.group: r.signatures for r in attribution.validated_lists(summary).collect()}
    assert lists == {g: sorted(kept.get(g, ())) for g in "pqr"}
    wide = attribution.activities(final.where("group = 'p'"), signatures).collect()
    assert [r["sample"] for r in wide] == ["p1", "p2", "p3"] and len(wide[0]) == 9 and all(r.S7 == 0 or "S7" in kept["p"] for r in wide)


def test_merged_groups_and_selection(spark, world):
    spectra, signatures, groups = world
    found, final = attribution.attribute(spectra, signatures, groups, replicates=10, merge_groups=True, selection=(0.02, 0.02), poisson=True)
    assert {r["sample"] for r in found.select("sample").distinct().collect()} == {"p", "q", "r"}
    own = {r.group: set(r.signatures) for r in attribution.validated_lists(attribution.validated(found, groups.select(F.col("group").alias("sample"), "group").distinct(), 1)).collect()}
    assert own["r"] == {"S5"} and {r.signature for r in final.where("group = 'r'").collect()} == {"S5"}
    assert final.count() == sum(len(own[r.group]) for r in groups.collect())


def test_poisson_replicates_vary_in_total_and_repeat_themselves():
    counts = np.full(96, 50.0)
    draws = [attribution.resampled(counts, "s", k, 1, poisson=True) for k in range(1, 40)]
    assert len({d.sum() for d in draws}) > 5 and abs(np.mean([d.sum() for d in draws]) - 4800) < 60
    assert (attribution.resampled(counts, "s", 3, 1, poisson=True) == draws[2]).all()
    assert all(attribution.resampled(counts, "s", k, 1).sum() == 4800 for k in (1, 2))


def test_counts_of_96_types(spark):
    rows = [(1, "C", "T", "ACG"), (1, "C", "T", "ACG"), (2, "G", "A", "CGT"), (3, "C", "C", "ACG"), (4, "N", "A", "ACG"), (5, "C", "A", "ANG"), (6, None, "A", "ACG"), (7, "T", "G", None)]
    got = {r.sbs96: r.counts for r in spectrum.counts96(spark.createDataFrame(rows, "k int, ref string, alt string, tri string"), ["k", "ref", "alt", "tri"]).collect()}
    assert len(got) == 96 and {k: v for k, v in got.items() if v} == {"A[C>T]G": 2}


def test_missing_masks_and_blanks_in_names(spark, tmp_path):
    assert tables.intervals(spark, str(tmp_path / "none.bed")).count() == 0
    (tmp_path / "empty.bed").write_text("")
    assert tables.intervals(spark, str(tmp_path / "empty.bed"), ["c"]).count() == 0
    with pytest.raises(AnalysisException):
        tables.contexts(spark, str(tmp_path / "none.bed")).collect()
    for name in ("my sample.context.bed", "a+b%20c.context.bed", "é.x.bed"):
        (tmp_path / name).write_text("c\t3\t4\tACG\t7\n")
        assert tables.contexts(spark, str(tmp_path / name.replace("%", "%"))).first()["sample"] == name.split(".")[0]
