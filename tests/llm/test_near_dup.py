import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.llm import near_dup
from strandweave.llm.graph import components

from .helpers import brute_components, copies, docs, prose


def told(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("width,percent,seed", [(3, 85, 1), (5, 80, 2)])
def test_agrees_with_all_pairs(spark, width, percent, seed):
    rows = copies(random.Random(seed), 12, 12, 3)
    got = near_dup.decisions(docs(spark, rows), width=width, percent=percent)
    assert told(got) == brute_components(rows, width, percent)


def test_a_pair_is_found_in_a_large_bucket(spark):
    """Two texts that share one band only, whose bucket holds a hundred others that are like nothing."""
    rng, hasher = random.Random(4), near_dup.MinHasher()
    sets = lambda words: near_dup.shingles(near_dup.word_hashes(" ".join(words), near_dup.WordHashes()), 5)
    sign = lambda words: np.frombuffer(hasher.sign(np.unique(sets(words))), "<u2")
    word = lambda: f"w{rng.randrange(10**9)}"
    while True:
        one = [word() for _ in range(50)]
        two = [*one[:25], word(), *one[26:]]
        same = (sign(one) == sign(two))[: near_dup.BANDS * near_dup.BAND].reshape(-1, near_dup.BAND).all(axis=1)
        if same.sum() == 1:
            break
    band = slice(near_dup.BAND * int(same.argmax()), near_dup.BAND * int(same.argmax()) + near_dup.BAND)
    least = sorted({int(np.flatnonzero(np.array([sign(one[k : k + 5])[h] for k in range(46)]) == sign(one)[h])[0]) for h in range(band.start, band.stop)})
    others = []
    while len(others) < 100:
        text = [w for k in rng.sample(least, len(least)) for w in [*one[k : k + 5], word()]]
        if (sign(text)[band] == sign(one)[band]).all():
            others.append(text)
    rows = [(k, " ".join(text)) for k, text in enumerate([one, two, *others])]
    small = told(near_dup.decisions(docs(spark, rows[:2]), width=5, percent=80))
    large = told(near_dup.decisions(docs(spark, rows), width=5, percent=80))
    assert small[1] == (46, 0) and large == brute_components(rows, 5, 80) and large[1] == small[1]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (7, "a b"), (7, "a b"), (None, "a b"), (8, "É x y z"), (9, "é x y z"), (10, "w " * 30_000)]
    got = near_dup.decisions(docs(spark, rows), width=3, percent=85).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert (by[1].n_shingles, by[1].component_id, by[1].kept) == (0, 1, True) and by[3].component_id == 3
    assert by[5].component_id == 4 and not by[5].kept and by[7].component_id == 6
    assert by[None].component_id is None and by[None].kept
    assert by[8].component_id == 8 and by[9].component_id == 9 and by[10].n_shingles == 1
    assert near_dup.decisions(docs(spark, []), width=3, percent=85).count() == 0


def test_one_of_each_keeps_columns(spark):
    rows = copies(random.Random(3), 5, 6, 2)
    table = docs(spark, rows).withColumn("n", F.lit(1)).withColumn("set_key", F.lit("x"))
    kept = near_dup.one_of_each(table)
    assert kept.columns == table.columns
    want = brute_components(rows, 5, 80)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_bayes_bound_is_monotone():
    steps = [near_dup.fewest_matches(0.8, n, 1e-6) for n in (32, 64, 96, 128)]
    assert steps == sorted(steps) and 0 < steps[0] < 32 * 0.8
    assert near_dup.fewest_matches(0.8, 128, 0.5) > steps[-1]


def test_components_of_a_long_chain(spark):
    import hashlib

    name = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    edges = [(name(i), name(i + 1)) for i in range(300)] + [("x", "y"), ("y", "y"), ("y", "x")]
    got = {r.vertex: r.label for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    least = min(name(i) for i in range(301))
    assert len(got) == 303 and all(got[name(i)] == least for i in range(301)) and got["y"] == "x"
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_a_hot_group_around_the_threshold(spark):
    """600 copies of one text, between 0.75 and 0.97 alike to it: as all pairs say, however large their buckets are."""
    rng = random.Random(12)
    base = prose(rng, 150)
    rows = [(0, " ".join(base))]
    for k in range(1, 600):
        text = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8])):
            text[rng.randrange(len(text))] = prose(rng, 1)[0] + str(rng.randrange(10**6))
        rows.append((k * 7 % 600, " ".join(text)) if k * 7 % 600 else (600, " ".join(text)))
    sets = sorted((i, near_dup.np.unique(near_dup.shingles(near_dup.word_hashes(t, near_dup.WordHashes()), 3))) for i, t in rows)
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    want = {i: (len(a), find(i)) for i, a in sets}
    assert 20 < sum(c == i for i, (_, c) in want.items()) < 580
    assert told(near_dup.decisions(docs(spark, rows), width=3, percent=85)) == want


@pytest.mark.parametrize("percent", [80, 85])
def test_rarest_tokens_are_shared_by_all_links(spark, percent):
    rng = np.random.default_rng(6)
    base = rng.integers(1 << 60, size=60)
    sets = []
    for _ in range(120):
        x = base.copy()
        at = rng.random(60) < rng.choice([0.02, 0.05, 0.1])
        x[at] = rng.integers(1 << 60, size=int(at.sum()))
        sets.append(np.unique(x[: rng.integers(50, 61)]))
    table = spark.createDataFrame([(bytes([k]), [int(v) for v in s]) for k, s in enumerate(sets)], "set_key binary, members array<long>")
    by = {}
    for r in near_dup.rarest_first(table, percent).collect():
        by.setdefault(r.token, []).append((r.set_key[0], r.n, r.at))
    met = set()
    for held in by.values():
        for a, n, at in held:
            for b, m, to in held:
                shared = -(-percent * (n + m) // (100 + percent))
                if a < b and at + shared <= n and to + shared <= m:
                    met.add((a, b))
    links = 0
    for a in range(120):
        for b in range(a + 1, 120):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links += 1
                assert (a, b) in met
    assert links > 100 and len(met) < 120 * 119 / 2
