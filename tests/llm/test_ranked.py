import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandweave.llm import ranked

from .helpers import docs, prose

ITEMS = "item_id long, text string"


def split(text):
    return re.findall(ranked.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, k=10):
    held = [(i, Counter(split(t))) for i, t in rows]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(x for _, c in held for x in c)
    out = []
    for item, text in items:
        found = []
        for place, (i, c) in enumerate(held):
            m = 25 + 75 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in split(text) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, place))
        out += [(item, r, None if none else i, -s) for r, (s, none, i, _) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def library(rng, n=150):
    rows = [(i, " ".join(rng.choice(["the", "of", "a"]) if rng.random() < 0.5 else x for x in prose(rng, rng.randint(0, 40)))) for i in range(n)]
    rows += [(1000 + j, rows[5][1]) for j in range(15)]  # ties
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, None), (2000, ""), (2001, "the " * 50_000), (2002, "É3 The")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"most_items": 2}, {"most_pairs": 3}])
def test_against_all_documents(spark, limits):
    rng = random.Random(8)
    rows = library(rng)
    items = [(i, " ".join((rng.choice(rows)[1] or "the").split(" ")[:12]) + " the THE") for i in range(7)] + [(7, None), (8, ""), (9, "nowhere-to-be-found-zzz"), (10, "é3, é3!")]
    got = ranked.search(docs(spark, rows).repartition(4), spark.createDataFrame(items, ITEMS), **limits)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_small_chunks_and_repeated_items(spark, monkeypatch):
    monkeypatch.setattr(ranked, "MOST_SUMMANDS", 7)
    rng = random.Random(9)
    rows, items = library(rng, 60), [(1, "the of"), (1, "the of"), (None, "a the")]
    wide = docs(spark, rows).withColumns({c: F.lit("x") for c in ("n", "terms", "rid", "q", "item", "m", "rank", "score", "__text")})
    got = ranked.search(wide, spark.createDataFrame(items, ITEMS).withColumn("q", F.lit(1)), k=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items, 4)


def test_empty_tables(spark):
    one, none = docs(spark, [(1, "a b")]), docs(spark, [])
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert ranked.search(none, items).count() == 0 and ranked.search(one, items.where("false")).count() == 0
    assert ranked.search(one, items.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        ranked.search(one, items.withColumnRenamed("item_id", "doc_id"), item_ident="doc_id")


def test_bytes_bound_the_exact_impacts(spark):
    found = spark.createDataFrame([(1, 5, n, [0, 1], [tf, 3 * tf]) for n in (1, 30, 10**6, 10**9) for tf in (1, 2, 50, 10**6)], "rid long, __id long, n long, terms array<int>, tfs array<long>")
    for r in ranked.quantised(found, 10**11, 5 * 10**13).collect():
        for b, tf in zip(r.impacts, r.tfs, strict=True):
            exact = 10**9 * tf // (1000 * tf + 8 * r.m)
            assert 0 <= b <= 255 and b * ranked.STEP >= exact and (b == 0 or (b - 1) * ranked.STEP < exact)
    assert {r.m for r in ranked.quantised(found, 10**11, 5 * 10**13).collect()} == {25 + 75 * n * 10**11 // (5 * 10**13) for n in (1, 30, 10**6, 10**9)}
