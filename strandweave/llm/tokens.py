"""Token ids of whole texts, by public tokenizers, with per-word memory.

This rests on the tokenizer's own pre-tokeniser: no merge crosses
the places where a text is split here, so encoding the parts once and
remembering them gives the ids of the whole text.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

#: Bytes that one memory of a worker may take, about: this much new, and as much of before. Longer texts aren't remembered.
MOST_BYTES, MOST_LETTERS = 75_000_000, 48
#: What Python needs for an entry beside its letters.
ENTRY_BYTES = 250


class Memory(dict):
    """text -> value, in two generations, so that common texts outlive the rare ones."""

    def __init__(self, most_bytes: int = MOST_BYTES):
        super().__init__()
        self.before: dict = {}
        self.taken, self.most_bytes = 0, most_bytes

    def make(self, key: str):
        raise NotImplementedError

    def __missing__(self, key: str):
        if len(key) > MOST_LETTERS:
            return self.make(key)
        if self.taken >= self.most_bytes:
            self.before = dict(self)
            self.clear()
            self.taken = 0
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        self.taken += ENTRY_BYTES + 12 * len(key)
        return value


def _byte_letters() -> dict[int, int]:
    """The alphabet of byte-level BPE: a printable byte is its own letter, the others take code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return dict(zip(own, own, strict=True)) | {b: 256 + k for k, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def letters_of(piece: str) -> str:
    return piece if piece.isascii() and " " not in piece else piece.encode().decode("latin-1").translate(BYTE_LETTERS)


class WordIds(Memory):
    """chunk without spaces -> its ids as little-endian 32-bit words.

    For tokenizers whose pre-tokeniser drops white space (word_bpe_49k.json).
    """

    def __init__(self, path: str, most_bytes: int = MOST_BYTES):
        super().__init__(most_bytes)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # a plain word is one pre-token, so the merges alone give its ids
        self.merges_alone = all(self._merged(x) == self._encoded(x) for x in ("the", "unthinkable", "québécois", "größenordnung", "a"))

    def _merged(self, word: str) -> bytes:
        found = self.model.tokenize(letters_of(word))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _encoded(self, chunk: str) -> bytes:
        found = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def make(self, chunk: str) -> bytes:
        body, last = chunk[:-1], chunk[-1:]
        if body and last in ".," and body.isalpha():  # letters and a mark are two pre-tokens
            return self[body] + self[last]
        if chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0100"):  # Latin-1 is in normal form, and lower-casing is plain
            low = chunk.lower()
            return self[low] if low != chunk else self._merged(chunk) if self.merges_alone else self._encoded(chunk)
        return self._encoded(chunk)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_ids(path: str, most_bytes: int = MOST_BYTES) -> WordIds:
    return WordIds(path, most_bytes)


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)
