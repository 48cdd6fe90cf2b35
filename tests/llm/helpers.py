"""Small fixtures and brute-force counterparts."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingle_set(text, width):
    w = words(text)
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def brute_components(rows, width, percent):
    """{doc_id: (n, component)} by comparing all pairs."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def copies(rng: random.Random, groups: int, size: int, edits: int, length: int = 80):
    """(doc_id, text): groups of edited copies of copies, shuffled, with some singles."""
    texts = []
    for _ in range(groups):
        base = prose(rng, rng.randint(length // 2, 2 * length))
        texts.append(base)
        for _ in range(size):
            base = list(rng.choice(texts[-3:]) if rng.random() < 0.3 else base)
            for _ in range(rng.randint(0, edits)):
                base[rng.randrange(len(base))] = prose(rng, 1)[0]
            texts.append(base)
    texts += [prose(rng, rng.randint(1, 60)) for _ in range(groups * 2)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]
