import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=10, top=10):
    rows = [((t or ""), (g or ""), (s or "")) for _, t, g, s in rows]
    out = []
    for lang in {g for _, g, _ in rows}:
        terms = [(s, re.findall(divergence.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t, g, s in rows if g == lang]
        df = Counter(x for _, ts in terms for x in set(ts))
        kept = sorted(x for x, n in df.items() if n >= least)
        counts = {s: Counter() for s, _ in terms}
        for s, ts in terms:
            counts[s].update(x for x in ts if df[x] >= least)
        whole = sum(counts.values(), Counter())
        share = lambda c: {x: 1 + 10**9 * (c[x] + 2) // (sum(c.values()) + 2 * len(kept)) for x in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(-sum(f(p[s][x], p[o][x]) for x in kept), o.encode(), o) for o in counts if o != s]
            term = [(-f(p[s][x], q[x]), x.encode(), x) for x in kept if counts[s][x] and p[s][x] > q[x]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", x, -v, r) for r, (v, _, x) in enumerate(sorted(term)[:top], 1)]
    return sorted(out)


def corpus(rng, n=240):
    words = {lang: [f"{lang}{chr(97 + k % 26)}{chr(97 + k // 26)}é" for k in range(120)] for lang in ("en", "de")}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de"])
        source = rng.choice(["hot"] * 5 + ["a", "b", "ß", "z"])
        own = words[lang][:60] if source == "hot" else words[lang]
        text = " ".join(rng.choice(own) if rng.random() < 0.9 else rng.choice(own).upper() + ",x9y" for _ in range(rng.randint(0, 40)))
        rows.append((i, text, lang, source))
    return rows


@pytest.mark.parametrize("limits", [{}, {"most_counters": 64, "most_entries": 50}])
def test_against_all_terms(spark, limits):
    """Also with sketches so small that terms take several ranges, and sums that don't fit at once."""
    rows = corpus(random.Random(1))
    rows += [(None, None, None, None), (500, "", "en", "empty"), (501, "lone words here", "xx", "one"), (502, "lone", "xx", None), (3, rows[3][1], *rows[3][2:]), (503, "enaaé " * 30_000, "en", "long")]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(4), **limits)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_no_rows_and_clashing_names(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = corpus(random.Random(2), 80)
    wide = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("n", "term", "docs", "h", "total", "p", "a", "b", "value", "rank")})
    assert sorted(tuple(r) for r in divergence.audit(wide, least=5, top=3).collect()) == brute(rows, 5, 3)


def test_a_sketch_never_tells_too_little_and_drops_rare_terms(spark):
    rng = random.Random(3)
    rows = [(rng.getrandbits(62), rng.randint(1, 4)) for _ in range(3000)]
    rows += [(h, 3) for h, _ in rows[:500]]
    table = spark.createDataFrame([(h, "l", "s", str(h), d, d) for h, d in rows], "h long, lang string, source string, term string, n long, docs long").repartition(5)
    told = divergence.sketch(table, 8192)
    real = Counter()
    for h, d in rows:
        real[h] += d
    h = np.array(list(real), np.int64)
    least = np.min([told[s] for s in divergence._slots(h, 8192)], axis=0)
    assert (least >= np.array(list(real.values()))).all() and (least == np.array(list(real.values()))).mean() > 0.9
    assert divergence.possible(table, told, 8192, 5).select("h").distinct().count() == int((least >= 5).sum())


def test_shares_of_large_counts(spark):
    rows = [(n, total, v) for n, total, v in [(0, 1, 1), (7, 7, 1), (4 * 10**12, 5 * 10**12, 10**6), (10**15, 8 * 10**15, 3 * 10**9)]]
    got = spark.createDataFrame(rows, "n long, t long, v long").select("n", "t", "v", divergence.share(F.col("n"), F.col("t"), F.col("v")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 2) // (r.t + 2 * r.v) for r in got)
