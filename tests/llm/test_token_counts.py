import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandweave.llm import token_counts
from strandweave.llm.tokens import WordIds, tokenizer_path

from .helpers import docs

TEXTS = ["one two\n\n\nthree\nfour", "", None, "\n", "\n\n", "Grüße  an\r\n alle\n", "日本語\nテキスト 😀😀\n", "a" * 300 + "\n" + " " * 50 + "b", "don't\n\n  indent\n\tx\n", "x" * 5 + "\n" * 9 + "y <|endoftext|> z"]


def brute(text, sections, rule, tok):
    offsets = tok.encode(text, add_special_tokens=False).offsets
    counts = [0] * len(sections)
    for a, b in offsets:
        shared = [min(b, e) - max(a, s) for s, e in sections]
        if rule == "majority":
            k = int(np.argmax(shared)) if shared and max(shared) > 0 else None
        else:
            p = a if rule == "start" else b - 1
            k = next((k for k, (s, e) in enumerate(sections) if s <= p < e), None)
        if k is not None:
            counts[k] += 1
    return counts, len(offsets)


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_lines_agree_with_brute_force(spark, tok, rule):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab é.\n\n  9'") for _ in range(rng.randint(1, 200))) for _ in range(60)]
    table = docs(spark, list(enumerate(texts))).withColumn("section", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = {}
    for r in token_counts.attribute(table, rule=rule).orderBy("doc_id", "section").collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        text = text or ""
        sections = [(r.start, r.end) for r in got[i]]
        assert "".join(text[a:b] for a, b in sections) == text
        counts, total = brute(text, sections, rule, tok)
        assert [r.n_tokens for r in got[i]] == counts and {r.doc_tokens for r in got[i]} == {total} and sum(counts) == total


def test_given_sections_with_gaps(spark, tok):
    text = "Title here\nbody of the   text goes on and on"
    rows = spark.createDataFrame([(1, text, [(0, 8), (13, 20), (20, 99), None]), (2, text, []), (3, None, None)], f"doc_id long, text string, fields {token_counts.SPANS}")
    got = token_counts.attribute(rows, sections="fields").orderBy("doc_id", "section").collect()
    assert [r.doc_id for r in got] == [1, 1, 1]
    assert [r.n_tokens for r in got] == brute(text, [(0, 8), (13, 20), (20, len(text))], "majority", tok)[0]


def test_no_rows(spark):
    assert token_counts.attribute(docs(spark, [])).count() == 0


def test_remembered_pieces_equal_the_tokenizers():
    ids, plain = WordIds(tokenizer_path("word_bpe_49k.json")), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    for text in [t or "" for t in TEXTS] + ["ÀÉ ÿß Ünd, İx ŒUVRE", "é ́x"]:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_special_tokens_count_as_the_tokenizer_has_them(spark, tok):
    got = token_counts.attribute(docs(spark, [(1, "hello <|endoftext|> you")])).collect()
    assert [r.n_tokens for r in got] == [len(tok.encode("hello <|endoftext|> you", add_special_tokens=False).ids)] == [4]


def test_any_spans_against_all_pairs():
    rng = random.Random(9)
    for _ in range(300):
        cuts = sorted(rng.sample(range(40), 8))
        sections = np.array([(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if rng.random() < 0.7] or [(3, 3)])
        at, tokens = 0, []
        while at < 38:
            to = at + rng.randint(1, 7)
            tokens.append((at, to))
            at = to if rng.random() < 0.8 else at  # tokens of one character's bytes share its span
        for rule in token_counts.RULES:
            counts, touches = token_counts.attributed(np.array(tokens), sections, rule)
            want, seen = [0] * len(sections), [0] * len(sections)
            for a, b in tokens:
                shared = [min(b, e) - max(a, s) for s, e in sections]
                p = a if rule == "start" else b - 1
                k = (int(np.argmax(shared)) if max(shared) > 0 else None) if rule == "majority" else next((k for k, (s, e) in enumerate(sections) if s <= p < e), None)
                if k is not None:
                    want[k] += 1
                held = [k for k, x in enumerate(shared) if x > 0]
                if held and not (len(held) == 1 and sections[held[0]][0] <= a and b <= sections[held[0]][1]):
                    for k in range(held[0], held[-1] + 1):
                        seen[k] += 1
            assert counts.tolist() == want and touches.tolist() == seen


def test_long_texts_and_clashing_names(spark, tok):
    text = "Grüße an alle, \n" * 6000
    got = token_counts.attribute(docs(spark, [(1, text), (1, text)]).withColumn("doc_tokens", F.lit("x"))).collect()
    assert len(got) == 12_000 and sum(r.n_tokens for r in got) == 2 * len(tok.encode(text, add_special_tokens=False).ids)
    with pytest.raises(ValueError, match="start"):
        token_counts.attribute(docs(spark, [(1, "a")]).withColumnRenamed("doc_id", "start"), ident="start")


def test_spans_by_pieces_equal_the_tokenizers_and_cost_less(tok, monkeypatch):
    rng = random.Random(5)
    spans = token_counts.PieceSpans(tokenizer_path("byte_bpe_50k.json"))
    odd = ["'", "'s", "'re", "'LL", " '", "''s", "\n", " ", "\t", "\x85", "\xa0", "\x1c", "\u2028", "é", "e\u0301", "ß", "Я", "日", "😀", "½", "٣", "Ⅷ", "x", "ab", "12", "_", "\u0558", "\u088f", "\U00010940", "<|endoftext|>"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(odd) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        assert spans.spans(text).tolist() == token_counts.token_spans(tok, text).tolist(), text
    assert spans.by_pieces and spans.odd.isdisjoint("\n'éЯ日") and "é" in spans.alike

    def whole(*_):
        raise AssertionError("a plain text was encoded as a whole")

    monkeypatch.setattr(token_counts, "token_spans", whole)
    assert len(spans.spans("It's a plain text,\nGrüße  an alle. " * 50)) > 50


def test_other_tokenizers_encode_texts_as_a_whole():
    path = tokenizer_path("word_bpe_49k.json")
    spans, plain = token_counts.PieceSpans(path), Tokenizer.from_file(path)
    assert not spans.by_pieces
    for text in [t or "" for t in TEXTS]:
        assert spans.spans(text).tolist() == token_counts.token_spans(plain, text).tolist()
