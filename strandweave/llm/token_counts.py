"""Token counts by offset-mapped attribution.

A whole document's tokens get their character spans once, as the tokenizer has them
(no merge crosses the pieces that its own pattern makes of a text, so a piece's
tokens are remembered and laid at its place). The spans meet those of the sections in an
interval join over two sorted lists, and a token that crosses a boundary goes to one
section by a stated rule, so that the counts of sections that tile a text add up
to the document's. No rows shuffle: a document carries its sections.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from .tokens import BYTE_LETTERS, Memory, tokenizer_path

#: start: where the token's first character lies; end: its last; majority: where most of its characters lie, the first of equals.
RULES = ("start", "end", "majority")
SPANS = "array<struct<start:int,end:int>>"


def line_spans(text: str) -> np.ndarray:
    """(n, 2) starts and ends of a text's lines, each with its newline; they tile the text. An empty text has one."""
    at, starts = text.find("\n"), [0]
    while at >= 0:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    if starts[-1] == len(text) and len(text):
        starts.pop()
    return np.stack([np.array(starts), np.append(starts[1:], len(text))], axis=1).astype(np.int64)


def token_spans(tokenizer: Tokenizer, text: str) -> np.ndarray:
    """(n, 2) starts and ends in characters of a whole text's tokens, in order.

    A token that holds part of a character's bytes spans that character. Strings of
    special tokens in a text are those tokens, as in any plain encoding.
    """
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    return np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)


def attributed(tokens: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, boundary-crossing tokens each touches).

    tokens: spans in order. sections: sorted spans that don't overlap; a token that
    touches none, or whose deciding character lies in a gap, counts for none.
    """
    n = len(sections)
    if not n or not len(tokens):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    (a, b), (starts, ends) = tokens.T, sections.T
    first = np.searchsorted(ends, a, side="right")  # the first section that ends after the token begins
    last = np.searchsorted(starts, b, side="left") - 1  # the last that begins before the token ends
    touches = first <= last
    inside = touches & (first == last) & (starts[np.minimum(first, n - 1)] <= a) & (b <= ends[np.minimum(first, n - 1)])
    goes = np.where(inside, first, -1)
    crossing = np.flatnonzero(touches & ~inside)
    touched = np.zeros(n + 1, np.int64)
    np.add.at(touched, first[crossing], 1)
    np.add.at(touched, last[crossing] + 1, -1)
    for k in crossing:
        own = np.arange(first[k], last[k] + 1)
        if rule == "majority":
            shared = np.minimum(b[k], ends[own]) - np.maximum(a[k], starts[own])
            goes[k] = own[shared.argmax()] if shared.max() > 0 else -1
        else:
            at = a[k] if rule == "start" else b[k] - 1
            held = own[(starts[own] <= at) & (at < ends[own])]
            goes[k] = held[0] if len(held) else -1
    return np.bincount(goes[goes >= 0], minlength=n), np.cumsum(touched)[:n]


COLUMNS = ("section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")


#: The pieces that byte-level BPE makes of a text, one after the other, before it merges within each.
PIECES = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The letter that stands for a space, and packings of so many pairs.
SPACE, _PAIRS = chr(BYTE_LETTERS[32]), [struct.Struct(f"<{2 * n}I") for n in range(32)]
#: Bytes that a worker's memory of pieces may take, as in `tokens`: twice as much as words do, since pieces are more.
MOST_BYTES = 150_000_000
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class PieceSpans(Memory):
    """piece -> its tokens' starts and ends in characters, as pairs of little-endian 32-bit words.

    Texts that hold a special token, or a character of which `regex` and the tokenizer's
    own pattern don't think alike (their Unicode versions may differ), are encoded
    by the tokenizer, and so are all of one that isn't plain byte-level BPE.
    """

    def __init__(self, path: str):
        super().__init__(MOST_BYTES)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        told = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"] for t in told["added_tokens"]]
        plain = {k: v for k, v in (told["pre_tokenizer"] or {}).items() if k in BYTE_LEVEL} == BYTE_LEVEL and told["model"]["type"] == "BPE"
        self.by_pieces = plain and not any(told[k] for k in ("normalizer", "post_processor", "truncation", "padding")) and not told["model"]["dropout"]
        self.alike, self.odd = set(), set()

    def make(self, piece: str) -> bytes:
        ascii = piece.isascii()
        letters = piece.replace(" ", SPACE) if ascii and piece.isprintable() else piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        ends = list(accumulate([len(t.value) for t in self.model.tokenize(letters)]))
        spans = [0]
        if ascii:
            for e in ends:
                spans += (e, e)
            spans.pop()
        else:  # from bytes to characters
            owner: list[int] = []
            for k, c in enumerate(piece):
                owner += (k,) if c < "\x80" else (k,) * len(c.encode())
            owner.append(len(piece))
            for e in ends:
                spans += (owner[e - 1] + 1, owner[e])
            spans.pop()
        return _PAIRS[len(ends)].pack(*spans) if len(ends) < len(_PAIRS) else struct.pack(f"<{2 * len(ends)}I", *spans)

    def probed(self, characters: set[str]) -> None:
        """Sort new characters into those that both patterns split alike beside each kind of others, and odd ones."""
        for c in characters:
            probe = f"a{c}a1{c}1!{c}! {c}\n"
            same = PIECES.findall(probe) == [probe[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
            (self.alike if same else self.odd).add(c)

    def spans(self, text: str) -> np.ndarray:
        """(n, 2) starts and ends in characters of a whole text's tokens, in order, as `token_spans` has them."""
        if not self.by_pieces or any(s in text for s in self.specials):
            return token_spans(self.tokenizer, text)
        found = set(text)
        if not found <= self.alike:
            self.probed(found - self.alike - self.odd)
            if not found.isdisjoint(self.odd):
                return token_spans(self.tokenizer, text)
        pieces = PIECES.findall(text)
        parts = list(map(self.__getitem__, pieces))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        tokens = np.fromiter(map(len, parts), np.int64, len(parts)) // 8
        at = np.repeat(np.concatenate(([0], ends[:-1]))[: len(pieces)], tokens)
        return np.frombuffer(b"".join(parts), "<u4").reshape(-1, 2) + at[:, None]


@lru_cache(maxsize=2)
def piece_spans(path: str) -> PieceSpans:
    return PieceSpans(path)


def attribute(docs: DataFrame, text: str = "text", ident: str = "doc_id", sections: str | None = None, rule: str = "majority", tokenizer: str | None = None) -> DataFrame:
    """One row per section of each row of docs: ident, section (from 0), start, end, n_tokens, n_crossing, doc_tokens.

    sections: an array<struct<start:int,end:int>> column of character spans;
    without it, a text's lines with their newlines. Spans are sorted; null
    ones are left out and ends are clipped to the text. Overlapping spans
    raise an error. Null text is empty: its one line has no tokens. Tokens are
    those of the whole text, whatever its length, and special tokens' strings count as those
    tokens. Rows repeated with the same ident give repeated rows; no rows, none. Other
    columns are not touched, whatever their names; an ident named like one of the result's columns is an error.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    if ident in COLUMNS:
        raise ValueError(f"the ident can't be named {ident}: the result has a column of that name")
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    given = F.col(sections).cast(SPANS) if sections else F.lit(None).cast(SPANS)
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"), given.alias("__spans"))
    schema = T.StructType().add("__id", narrow.schema["__id"].dataType).add("section", "integer").add("start", "integer").add("end", "integer").add("n_tokens", "long").add("n_crossing", "long").add("doc_tokens", "long")

    def spans_of(body: str, spans) -> np.ndarray:
        if spans is None:
            return line_spans(body) if sections is None else np.zeros((0, 2), np.int64)
        kept = sorted((min(max(0, s["start"]), len(body)), min(s["end"], len(body))) for s in spans if s and s["start"] is not None and s["end"] is not None and s["start"] <= s["end"])
        if any(a[1] > b[0] for a, b in zip(kept, kept[1:], strict=False)):
            raise ValueError("sections overlap")
        return np.array(kept, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_spans(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part, whose, found = batch.slice(at, 256), [], []
                for k in range(len(part)):
                    body = part.column(1)[k].as_py() or ""
                    where = spans_of(body, part.column(2)[k].as_py())
                    spans = encoder.spans(body)
                    tokens, touches = attributed(spans, where, rule)
                    whose.append(np.full(len(where), k))
                    found.append((np.arange(len(where)), where[:, 0], where[:, 1], tokens, touches, np.full(len(where), len(spans))))
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.concatenate(whose))), *(pa.array(c.astype(t)) for c, t in zip(columns, (np.int32, np.int32, np.int32, np.int64, np.int64, np.int64), strict=True))], names=schema.names)

    return narrow.mapInArrow(run, schema).withColumnRenamed("__id", ident)
