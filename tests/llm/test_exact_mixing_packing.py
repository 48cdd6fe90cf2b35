import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandweave.llm import exact_dedup, mixing, packing
from strandweave.llm.tokens import tokenizer_path

from .helpers import docs, prose


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(spark):
    rng = random.Random(1)
    stock = [" ".join(prose(rng, 8)) for _ in range(60)]
    rows = [(i, rng.choice(stock) if i % 3 else " ".join(prose(rng, 9))) for i in range(900)] + [(1000, "hot")] * 3 + [(2000 + i, "HOT") for i in range(400)] + [(3000, None), (3001, ""), (3002, "É"), (3003, "é"), (None, "only"), (None, "hot")]
    table = docs(spark, rows).withColumn("__sha", F.lit("x"))
    for bits in (exact_dedup.MAX_FILTER_BITS, 2 * exact_dedup.PAGE_BITS):
        got = exact_dedup.decisions(table, max_filter_bits=bits).collect()
        groups = {}
        for i, t in rows:
            groups.setdefault(lower(t), []).append(i)
        sizes = sorted((r.doc_id is None, r.doc_id or 0, r.group_size, r.keep_id) for r in got)
        best = lambda ids: max((i for i in ids if i is not None), default=None)
        assert sizes == sorted((i is None, i or 0, len(groups[lower(t)]), best(groups[lower(t)])) for i, t in rows)
        assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.distinct_rows(docs(spark, rows)).collect()
    assert sorted((lower(r.text), r.doc_id or 0) for r in kept) == sorted((t, best(ids) or 0) for t, ids in groups.items())
    assert exact_dedup.decisions(docs(spark, [])).count() == 0 and exact_dedup.distinct_rows(docs(spark, [])).count() == 0


def test_mixing_rates(spark):
    rows = [(i, "x" * 100, "big" if i < 3000 else "small" if i < 3600 else "empty") for i in range(3600)] + [(9000, None, "empty"), (9001, "y" * 50, None)]
    table = docs(spark, rows).withColumn("copy", F.lit("mine"))
    got = mixing.mix(table, weights={"big": 1.0, "small": 3.0}, epochs=1.0)
    counts = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    total = 3600 * 100 + 50
    for source, share in (("big", 0.25), ("small", 0.75)):
        want = share * total / 100
        assert abs(counts[source] - want) < 5 * math.sqrt(want) + 1
    assert set(counts) == {"big", "small"}
    drawn = got.groupBy("doc_id").agg(F.max("n_copies").alias("n"), F.count(F.lit(1)).alias("rows"), F.countDistinct("copy").alias("copies"))
    assert drawn.where("n <> rows or n <> copies").isEmpty()
    rate = [r.rate for r in got.select("source", "rate").distinct().where("source = 'small'").collect()][0]
    per = [r.n for r in drawn.where("doc_id >= 3000").collect()]
    assert abs(np.mean(per + [0] * (600 - len(per))) - rate) < 0.5 and abs(np.var(per + [0] * (600 - len(per))) / rate - 1) < 0.3
    assert got.exceptAll(mixing.mix(table.repartition(3), weights={"big": 1.0, "small": 3.0})).isEmpty()
    assert mixing.mix(docs(spark, [])).count() == 0
    names = ["__parts", "__source", "__cdf", "__row", "__ident", "__want"]
    clash = mixing.mix(table.select("*", *[F.col("doc_id").alias(c) for c in names]), weights={"big": 1.0, "small": 3.0})
    assert clash.select(*got.columns).exceptAll(got).isEmpty() and clash.where("__parts <> doc_id or __row <> doc_id").isEmpty()


def test_exact_keeps_clashing_columns(spark):
    names = ["__sha", "__maybe", "__slot0", "__page0", "__set0", "__row", "__id"]
    table = docs(spark, [(1, "A b"), (2, "a B"), (3, "c" * 100_000), (4, None), (5, "")]).select("*", *[F.col("doc_id").alias(c) for c in names])
    kept = exact_dedup.distinct_rows(table)
    assert kept.columns == table.columns
    got = kept.collect()
    assert {r.doc_id for r in got} == {2, 3, 5} and all(r[c] == r.doc_id for r in got for c in names)
    assert exact_dedup.decisions(table).count() == 5


def test_packing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(prose(rng, rng.choice([0, 3, 40, 400])))) for i in range(300)] + [(500, None), (501, "Word, word! " * 3000), (None, "a b"), (7, "twice"), (7, "twice")]
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = packing.pack(docs(spark, rows).withColumn("piece", F.lit(1)), capacity=256, open_bins=8, pieces_per_task=150).collect()
    want = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, at, len(ids[at : at + 256]), zlib.crc32(ids[at : at + 256].tobytes())) for k, at in enumerate(range(0, len(ids), 256))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 256
    assert len(bins) <= 1.1 * sum(w[3] for w in want) / 256 + 4
    assert packing.pack(docs(spark, [])).count() == 0


def test_fullest_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert bins.place(8) == (2, 0)  # two are open: the one with 3 free closes
    assert bins.place(4) == (0, 6) and bins.place(2) == (2, 8)


def test_the_bound_binds_and_hardly_a_place_is_lost():
    """A full task of the query: pieces of all lengths in any order, more bins than may be open."""
    rng = np.random.default_rng(4)
    lengths = np.where(rng.random(20_000) < 0.2, 2048, np.minimum(2048, 1 + rng.gamma(2.0, 350.0, 20_000).astype(np.int64)))
    bins = packing.OpenBins(packing.CAPACITY, packing.OPEN_BINS)
    number, offset = packing.placed(lengths, bins, packing.LOOK_AHEAD)
    assert bins.forced > 1000 and bins.open <= packing.OPEN_BINS
    assert bins.made <= 1.003 * lengths.sum() / packing.CAPACITY + 1
    order = np.lexsort((offset, number))
    ends = np.zeros(bins.made, np.int64)
    for b, o, n in zip(number[order], offset[order], lengths[order], strict=True):
        assert o == ends[b]
        ends[b] += n
    assert ends.max() <= packing.CAPACITY and ends.min() > 0


def test_idents_that_clash_are_refused(spark):
    table = docs(spark, [(1, "a")])
    for name in ("piece", "offset"):
        with pytest.raises(ValueError, match=name):
            packing.pack(table.withColumnRenamed("doc_id", name), ident=name)


def test_a_small_memory_of_words_gives_the_same_pieces(spark):
    rng = random.Random(11)
    table = docs(spark, [(i, " ".join(prose(rng, 300))) for i in range(20)])
    path = packing.tokenizer_path("word_bpe_49k.json")
    few, many = (sorted(packing.pieces(table, "text", "doc_id", path, memory_bytes=n).collect()) for n in (2_000, 20_000_000))
    assert few == many and len(few) == 20
