import random
import zlib

import numpy as np

from pyspark.sql import functions as F

from strandweave.llm import toxicity

from .helpers import docs, prose


def corpus(n, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words, bad = prose(rng, rng.randint(5, 40)), rng.random() < 0.3
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "Awful", "nasty"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500)
    table, known = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.verdicts(table, toxicity.train(table, known)).join(known, "doc_id").collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and sum(r.predicted == r.toxic for r in held) / len(held) > 0.97


def test_held_out_labels_do_not_matter(spark):
    rows, labels = corpus(300)
    table = docs(spark, rows)
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.train(table, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, other))
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights) and 0 < len(a.places) < 200


def test_odd_rows(spark):
    rows, labels = corpus(200)
    model = toxicity.train(docs(spark, rows), spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int"))
    odd = docs(spark, [(1, None), (1, None), (2, ""), (None, "vile"), (3, "a " * 50_000)]).withColumn("score", F.lit("mine"))
    got = toxicity.verdicts(odd, model).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and all(r.predicted == 0 for r in got if r.doc_id in (1, 2))
    wide = odd.withColumns({c: F.lit(c) for c in ("__score", "c0", "c1", "held_out")})
    kept = toxicity.without_toxic(wide, model)
    assert kept.columns == wide.columns and {(r.score, r["__score"], r.c1) for r in kept.collect()} == {("mine", "__score", "c1")}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score < 0.5}
    assert toxicity.verdicts(docs(spark, []), model).count() == 0
    empty = toxicity.train(docs(spark, rows), spark.createDataFrame([], "doc_id long, toxic int"))
    assert empty.rows == 0 and toxicity.verdicts(docs(spark, rows), empty).agg(F.max("score")).first()[0] == 0.0


def test_the_sample_is_bounded(spark):
    rows, labels = corpus(600)
    table, known = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    assert 50 < toxicity.fit(table, known, "toxic", max_rows=100).rows < 160


def test_rows_that_repeat_a_labelled_document_count_once(spark):
    rows, labels = corpus(120)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    one = toxicity.train(docs(spark, rows), known)
    many = toxicity.train(docs(spark, rows + rows[:40] * 5), known)
    assert one.rows == many.rows and one.bias == many.bias and np.array_equal(one.weights, many.weights)


def test_learning_equals_a_plain_loop():
    """The published update, a coordinate at a time, in dictionaries."""
    rng, how, bits = np.random.default_rng(3), toxicity.Ftrl(), 8
    rows = [(int(rng.random() < 0.4), np.unique(rng.integers(0, 1 << bits, rng.integers(0, 12))).astype(np.int32)) for _ in range(80)]
    z, n, bias = {}, {}, 1 << bits

    def weight(k):
        if k != bias and abs(z.get(k, 0.0)) <= how.l1:
            return 0.0
        shrunk = z.get(k, 0.0) - (0.0 if k == bias else how.l1 * np.sign(z.get(k, 0.0)))
        return -shrunk / ((how.beta + n.get(k, 0.0) ** 0.5) / how.alpha + how.l2)

    for _ in range(how.passes):
        for y, places in rows:
            at = [*places.tolist(), bias]
            w = [weight(k) for k in at]
            g = 1 / (1 + np.exp(-sum(w))) - y
            for k, own in zip(at, w, strict=True):
                sigma = ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / how.alpha
                z[k], n[k] = z.get(k, 0.0) + g - sigma * own, n.get(k, 0.0) + g * g
    found_bias, places, weights = toxicity.learn(rows, bits, how)
    assert np.isclose(found_bias, weight(bias)) and places.tolist() == sorted(k for k in z if k != bias and abs(z[k]) > how.l1)
    assert np.allclose(weights, [weight(k) for k in places.tolist()])
