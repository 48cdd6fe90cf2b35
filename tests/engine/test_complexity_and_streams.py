import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.operators import complexity, intervals, molecules, pairing
from strandweave.streaming.pairing import depth_stream, pair_in_order_stream


def brute(seq, window, threshold):
    """All intervals, each against all intervals inside it."""
    n, score = len(seq), {}
    for a in range(n):
        for b in range(a + 4, min(n, a + window) + 1):
            part = seq[a:b].upper()
            if set(part) <= set("ACGT"):
                counts = {}
                for k in range(len(part) - 2):
                    counts[part[k : k + 3]] = counts.get(part[k : k + 3], 0) + 1
                score[a, b] = sum(c * (c - 1) / 2 for c in counts.values()) / (len(part) - 3)
    held = set()
    for (a, b), s in score.items():
        if s > threshold and all(score.get((c, d), 0) <= s for c in range(a, b) for d in range(c + 4, b + 1)):
            held.update(range(a, b))
    out = []
    for p in sorted(held):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(x) for x in out]


def sequence(rng, n):
    """Random letters with repeats of one to four letters, and strange ones."""
    out = ""
    while len(out) < n:
        kind = rng.random()
        out += "".join(rng.choices("ACGT", k=rng.randint(3, 25))) if kind < 0.6 else "".join(rng.choices("ACGT", k=rng.randint(1, 4))) * rng.randint(4, 12) if kind < 0.95 else rng.choice(["N", "NN", "r", "acgt"])
    return out[:n]


@pytest.mark.parametrize("window,threshold", [(12, 0.5), (20, 1.0), (64, 2.0)])
def test_dust_against_all_windows(window, threshold):
    rng = random.Random(window)
    for n in (0, 1, 3, 4, 5, 30, 90, 140):
        seq = sequence(rng, n)
        a, b = complexity.perfect(np.frombuffer(seq.encode(), np.uint8), n, window, threshold)
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == brute(seq, window, threshold)


def test_tiles_and_slices_give_the_whole(spark, monkeypatch):
    rng = random.Random(1)
    bodies = {"a": sequence(rng, 700), "b": sequence(rng, 63), "c": "A" * 200, "d": "A"}
    rows = spark.createDataFrame(list(bodies.items()), "contig string, seq string")
    want = sorted((c, *x) for c, body in bodies.items() for x in brute(body, 16, 1.0))
    for size in (16, 64, 1000):
        got = complexity.low_complexity(molecules.reference_tiles(rows, size), size, 16, 1.0)
        assert sorted(tuple(r) for r in got.select("contig", "start", "end").collect()) == want
    monkeypatch.setattr(complexity, "SLICE", 50)
    assert sorted(tuple(r) for r in complexity.of_sequences(rows, "contig", "seq", 16, 1.0).collect()) == want
    widened = intervals.slop(got.withColumn("length", F.lit(700)), 3, "length")
    assert widened.agg(F.min("start")).first()[0] == 0


def test_query_over_texts(spark, tmp_path):
    from strandweave.plans.catalogue import QUERIES

    texts = {1: "The " + "ha" * 30 + "!", 2: None, 3: "", 4: "Nothing of note here, 12 times. " + "é".join("aeiaeiaei" * 5), 5: "z" * 70}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in texts.items():
        seq = "".join("ACGT"[(ord(c) - 97) % 4] if "a" <= c <= "z" else "N" if c not in "ACGT" else c for c in (text or "").lower())
        want += [(i, *x) for x in brute(seq, 64, 2.0)]
    assert sorted(tuple(r) for r in QUERIES["low_complexity"](spark, str(tmp_path)).collect()) == want and len(want) == 2


@pytest.mark.parametrize("per_batch", [1, 2, 7])
def test_streamed_queue_makes_the_pairs_of_the_table(spark, tmp_path, per_batch):
    rng = random.Random(per_batch)
    rows = [(rng.randint(0, 25), rng.choice(["fwd", "rev"]), k, rng.randint(0, 99)) for k in range(140)]
    schema = "zm long, strand string, at long, pos int"
    for k in range(7):
        spark.createDataFrame(rows[20 * k : 20 * (k + 1)], schema).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    import glob
    import os
    import shutil

    os.makedirs(f"{tmp_path}/in")
    for k in range(7):
        (part,) = glob.glob(f"{tmp_path}/in{k}/*.parquet")
        shutil.copy(part, f"{tmp_path}/in/{k}.parquet")
        os.utime(f"{tmp_path}/in/{k}.parquet", (1_700_000_000 + 60 * k,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(f"{tmp_path}/in")
    name = f"queue{per_batch}"
    query = pair_in_order_stream(stream, ["zm"], "strand", "at", "fwd", "rev", ["pos"]).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/check").start()
    try:
        query.processAllAvailable()
        got = sorted(tuple(r) for r in spark.sql(f"select zm, at_1, at_2, pos_1, pos_2 from {name}").collect())
    finally:
        query.stop()
    table = pairing.in_order(spark.createDataFrame(rows, schema), ["zm"], "strand", "at")
    want = pairing.pair(table, ["zm", "mol"], "strand", "fwd", "rev", ["at", "pos"])
    assert got == sorted(tuple(r) for r in want.select("zm", "at_1", "at_2", "pos_1", "pos_2").collect()) and len(got) > 30


def test_streamed_depth_is_told_once_a_window_is_over(spark, tmp_path):
    rows = [("c", "2024-01-01 00:10:00"), ("c", "2024-01-01 00:50:00"), ("d", "2024-01-01 00:20:00"), ("c", "2024-01-01 01:30:00"), ("c", "2024-01-01 03:00:00")]
    spark.createDataFrame(rows, "contig string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("contig string, t timestamp").parquet(f"{tmp_path}/in")
    query = depth_stream(stream, ["contig"], "t").writeStream.format("memory").queryName("depths").outputMode("append").start()
    try:
        query.processAllAvailable()
        got = sorted((r.contig, r.start.hour, r.depth) for r in spark.sql("select * from depths").collect())
    finally:
        query.stop()
    assert got == [("c", 0, 2), ("c", 1, 1), ("d", 0, 1)]
