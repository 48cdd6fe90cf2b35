import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandweave.llm import cutting
from strandweave.llm.tokens import tokenizer_path

from .helpers import docs, prose


def brute(rows, capacity, end=2):
    """ident -> ids, and the lengths that the sequences must have."""
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]
    total = sum(len(x) for _, x in ids)
    rest = total % capacity
    return ids, [capacity] * (total // capacity) + [1 << k for k in range(20, -1, -1) if rest >> k & 1]


def check(got, rows, capacity):
    ids, lengths = brute(rows, capacity)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
    assert sorted((sum(n for _, n in p) for p in filled.values()), reverse=True) == lengths
    # rows that share an ident are documents of their own, told apart by where their stream begins
    places = sorted((r.sequence_id, r.offset, r) for r in got)
    streams, whole = [], []
    for _, _, r in places:
        if r.start == 0:
            streams.append((r.doc_id, []))
        streams[-1][1].append(r)
    for ident, parts in streams:
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
        whole.append((ident, parts[0].doc_tokens, tuple((p.start, p.length, p.ids_crc32) for p in parts)))
    want = sorted((i is None, i or 0, len(x)) for i, x in ids)
    assert sorted((i is None, i or 0, n) for i, n, _ in whole) == want
    pool = list(ids)
    for ident, _, parts in whole:
        match = next(k for k, (i, x) in enumerate(pool) if i == ident and all(zlib.crc32(struct.pack(f"<{n}I", *x[a : a + n])) == c for a, n, c in parts) and len(x) == sum(n for _, n, _ in parts))
        pool.pop(match)
    assert not pool


@pytest.mark.parametrize("capacity", [1, 16, 256])
def test_streams_against_the_tokenizer(spark, capacity):
    rng = random.Random(3)
    rows = [(i, " ".join(prose(rng, rng.randint(0, 60)))) for i in range(60)]
    rows += [(7, rows[7][1]), (7, "Other, text."), (None, "nothing"), (None, None), (90, ""), (91, None), (92, "<|endoftext|> é́ ﬁ 東京"), (93, " ".join(prose(rng, 5000)))]
    check(cutting.cut(docs(spark, rows).repartition(5), capacity=capacity).collect(), rows, capacity)


def test_extra_columns_long_texts_and_no_rows(spark):
    rows = [(i, "word " * n) for i, n in enumerate((0, 1, 40_000, 3))]
    wide = docs(spark, rows).withColumns({c: F.lit("x") for c in ("__id", "part", "ids", "at", "n", "piece", "sequence_id", "offset")})
    check(cutting.cut(wide, capacity=64).collect(), rows, 64)
    assert cutting.cut(docs(spark, [])).count() == 0
    with pytest.raises(ValueError, match="length"):
        cutting.cut(docs(spark, rows).withColumnRenamed("doc_id", "length"), ident="length")
    with pytest.raises(ValueError, match="power of two"):
        cutting.cut(docs(spark, rows), capacity=100)


def test_sequences_hold_the_ids_and_their_boundaries(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, rng.randint(0, 80)))) for i in range(30)]
    ids, lengths = brute(rows, 128)
    made = cutting.sequences(cutting.cut(docs(spark, rows), capacity=128, with_ids=True)).orderBy("sequence_id").collect()
    assert [len(r.ids) for r in made] == lengths
    parts = {}
    for r in made:
        for b in r.boundaries:
            parts.setdefault(b.doc_id, []).append((b.start, r.ids[b.offset : b.offset + b.length]))
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in parts.items()} == dict(ids)


def test_left_over_windows():
    assert cutting.tail_windows(4096 * 3, 4096) == []
    assert cutting.tail_windows(4096 + 13, 4096) == [(1, 4096, 4104), (2, 4104, 4108), (3, 4108, 4109)]
