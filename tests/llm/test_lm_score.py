import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandweave.llm import lm_score

from .helpers import docs, prose, words


def brute(rows, order, backoff, cutoff):
    split = [words(t) for _, t in rows]
    counts = [Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1)) for n in range(order + 1)]
    total = sum(map(len, split))

    def score(w, i, n):
        if n == 1:
            return math.log(counts[1][(w[i],)] / total)
        if i + 1 < n:
            return score(w, i, n - 1)
        gram = tuple(w[i - n + 1 : i + 1])
        c = counts[n][gram]
        return math.log(c / counts[n - 1][gram[:-1]]) if c >= cutoff else math.log(backoff) + score(w, i, n - 1)

    return [(i, len(w), sum(score(w, k, order) for k in range(len(w)))) for (i, _), w in zip(rows, split, strict=True)]


@pytest.mark.parametrize("order,backoff,cutoff", [(3, 0.4, 2), (2, 0.3, 1), (4, 0.4, 3), (1, 0.4, 2)])
def test_agrees_with_brute_force(spark, order, backoff, cutoff):
    rng = random.Random(order)
    stock = prose(rng, 12)
    rows = [(i, " ".join(rng.choice(stock) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, "One"), (152, "One"), (None, "x y z"), (153, "a b " * 30_000)]
    table = docs(spark, rows).withColumn("gram", F.lit(1)).withColumn("key", F.lit("x")).withColumn("score", F.lit("x"))
    got = lm_score.scores(table, order=order, backoff=backoff, cutoff=cutoff).collect()
    want = brute(rows, order, backoff, cutoff)
    key = lambda r: (r[0] is None, r[0] or 0, round(r[2], 4))
    for a, b in zip(sorted(((r.doc_id, r.n_words, r.log_score) for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)


def test_empty_table(spark):
    assert lm_score.scores(docs(spark, [])).count() == 0


def test_idents_that_clash_are_refused(spark):
    with pytest.raises(ValueError, match="n_words"):
        lm_score.scores(docs(spark, [(1, "a")]).withColumnRenamed("doc_id", "n_words"), ident="n_words")


@pytest.mark.parametrize("order", [2, 3, 4])
def test_frequent_words_are_dealt_to_several_tasks(spark, order, monkeypatch):
    """Words too frequent for one task, words whose counts don't go to every task, and few of all rows at a time."""
    rng = random.Random(7)
    stock = prose(rng, 40)
    rows = [(i, " ".join(rng.choice(["the", "of", rng.choice(stock)]) for _ in range(rng.randint(0, 40)))) for i in range(100)]
    made = []
    real = lm_score.exploded
    monkeypatch.setattr(lm_score, "exploded", lambda *a: made.append((real(*a), a[2])) or made[-1][0])
    got = lm_score.scores(docs(spark, rows), order=order, top_words=8, task_rows=200).collect()
    want = brute(rows, order, 0.4, 2)
    for a, b in zip(sorted((r.doc_id, r.n_words, r.log_score) for r in got), sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)
    total = sum(len(words(t)) for _, t in rows)
    sizes = [df.count() for df, _ in made]
    assert len(made[0][1]) >= 2 and len(sizes) >= 3 and sum(sizes) == total and max(sizes) < 0.75 * total
