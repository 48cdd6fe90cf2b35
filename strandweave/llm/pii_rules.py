"""What counts as personal data in a text, and how one value is turned into another of its kind."""

from __future__ import annotations

import bisect
import hashlib
import re

# Given names by script and gender, and titles by gender.
GIVEN = {
    ("latin", "f"): "Alice Anna Camille Carmen Charlotte Claire Elena Emily Emma Hannah Ingrid Isabel Julia Laura Lucia Maria Marie Olivia Sarah Sophie".split(),
    ("latin", "m"): "Alexander Antoine Carlos Charles David Diego Edward Felix George Henri James Javier Johann John Klaus Michael Pablo Peter Robert Thomas".split(),
    ("cyrillic", "f"): "Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Андрей Дмитрий Иван Михаил Николай Сергей Юрий".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Dr": "x", "Prof": "x", "господин": "m", "госпожа": "f"}
SYLLABLES = {"latin": "ba be bo da del fen gar hal kin lan lor mar mel nor ral ros sel tan tor vin".split(), "cyrillic": "ба ве го дан зор кал лен мар нов пол рин сав тол фед чер".split()}
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя"}

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_NAME = r"[A-ZÀ-ÖØ-ÞА-Я][\w’'\-]*\w"
_EMAIL = re.compile(r"(?<![\w.%+\-])[\w.%+\-]++@(?:[\w\-]+\.)+[A-Za-z]{2,24}(?!\w)")
_SECRET = re.compile(r"""\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[=:]\s*["']?([^\s"']{8,})""", re.I)
_HEX = re.compile(r"(?<!\w)[0-9a-fA-F]{32,}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
_IPV4 = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_CARD = re.compile(r"(?<![\w.+])\d(?:[ \-]?\d){12,18}(?!\w)")
_NATIONAL = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}|\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4})(?!\w)")
_TITLED = re.compile(rf"(?<!\w)({'|'.join(TITLES)})\.? ({_NAME}(?: {_NAME}){{0,2}})")
_GIVEN_THEN = re.compile(rf"(?<!\w)({'|'.join(_GENDER)}) ({_NAME})")
_DIGIT, _MARKS = re.compile(r"[0-9]"), re.compile("|".join(sorted({t for t in TITLES} | {n for n in _GENDER})))


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("phone", "card", "national"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv4":
        return value
    return value.lower() if kind in ("email", "hex") or ":" in kind else value


def _luhn(digits: str) -> int:
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10


def _people(text: str):
    spans = [(m.start(2), m[2], TITLES[m[1]]) for m in _TITLED.finditer(text)] + [(m.start(1), m[0], "x") for m in _GIVEN_THEN.finditer(text)]
    for start, name, gender in spans:
        words, at = name.split(" "), start
        for k, word in enumerate(words):
            script = script_of(word)
            if k + 1 == len(words):
                kind = f"family:{script}"
            else:
                kind = f"given:{script}:{_GENDER[word][1] if word in _GENDER else 'm' if gender == 'x' else gender}"
            yield at, at + len(word), kind, word
            at += len(word) + 1


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text, in order, none overlapping; earlier rules win."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0]) for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            end = m.start(1) + len(re.split(r"[^\w./+\-]", m[1])[0])
            if end - m.start(1) >= 8:
                value = text[m.start(1) : end]
                found.append((m.start(1), end, "hex" if re.fullmatch("[0-9a-fA-F]+", value) else "secret", value))
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "hex", m[0]) for m in _HEX.finditer(text) if not m[0].isalpha() and not m[0].isdigit()]
        found += [(m.start(), m.end(), "iban", m[0]) for m in _IBAN.finditer(text)]
        found += [(m.start(), m.end(), "ipv4", m[0]) for m in _IPV4.finditer(text) if all(int(x) < 256 for x in m[0].split("."))]
        for kind, rule, least in (("national", _NATIONAL, 9), ("card", _CARD, 13), ("phone", _PHONE, 8)):
            found += [(m.start(), m.end(), kind, m[0]) for m in rule.finditer(text) if sum(c.isdigit() for c in m[0]) >= least]
    if _MARKS.search(text):
        found += list(_people(text))
    kept: list[tuple[int, int, str, str]] = []
    starts: list[int] = []  # of what is kept, in order: only the neighbours of a place can overlap it
    for start, end, kind, value in found:
        k = bisect.bisect_left(starts, start)
        if end > start and (k == 0 or kept[k - 1][1] <= start) and (k == len(kept) or end <= starts[k]):
            starts.insert(k, start)
            kept.insert(k, (start, end, kind, canonical(kind, value)))
    return kept


class Draws:
    """Numbers made from a key and a value: the same ones whenever it is asked."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.round, self.held = key, "\0".join(map(str, what)).encode(), 0, b""

    def below(self, most: int) -> int:
        if len(self.held) < 4:
            self.held += hashlib.blake2b(self.what + b"\0%d" % self.round, key=self.key[:64]).digest()
            self.round += 1
        number, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return number % most


def _shape(draws: Draws, value: str, hexadecimal: bool = False) -> str:
    """Letters for letters of their script and case, digits for digits, all else as it is."""
    out = []
    for c in value:
        if c in "0123456789":
            out.append("0123456789"[draws.below(10)])
        elif c.isalpha():
            letters = "abcdef" if hexadecimal else ALPHABETS[script_of(c)]
            new = letters[draws.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _network(value: str) -> int:
    """How many numbers at the start of an address tell its private network."""
    own = value.split(".")
    return 2 if own[:2] == ["192", "168"] else 1 if own[0] in ("10", "127") else 0


#: Kinds whose mentions hold a fixed number of letters and digits, so that replacements can't grow.
FIXED_FORMAT = ("ipv4", "phone", "card", "national", "iban")


def space(kind: str, value: str) -> str:
    """What a replacement keeps of a value of a kind of fixed format: values of one space may replace each other."""
    if kind == "ipv4":
        return ".".join(value.split(".")[: _network(value)])
    if kind == "phone":
        return f"{value[: max(0, len(value) - 10)]} {len(value)}"
    if kind == "card":
        return f"{len(value)} {_luhn(value) == 0}"
    if kind == "iban":
        return f"{value[:2]} {re.sub('[A-Z]', 'A', re.sub('[0-9]', '0', value[2:]))} {_mod97(value) == 1}"
    return ""


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The attempt-th canonical replacement of a canonical value; those without a fixed format grow with the attempts."""
    draws, longer = Draws(key, kind, value, attempt), attempt // 4
    if kind == "email":
        local, _, domain = value.rpartition("@")
        name, _, top = domain.rpartition(".")
        return f"{_shape(draws, local + 'x' * longer)}@{_shape(Draws(key, 'domain', domain), name)}.{top}"
    if kind == "ipv4":
        own, fixed = value.split("."), _network(value)
        return ".".join([*own[:fixed], *(str(1 + draws.below(254)) for _ in own[fixed:])])
    if kind == "phone":
        country = max(0, len(value) - 10)
        return value[:country] + _shape(draws, value[country:])
    if kind == "card":
        new = _shape(draws, value)
        return next(x for x in (new[:-1] + d for d in "0123456789") if _luhn(x) == 0) if _luhn(value) == 0 else new
    if kind == "iban":
        body = _shape(draws, value[4:])
        return f"{value[:2]}{98 - _mod97(value[:2] + '00' + body):02d}{body}" if _mod97(value) == 1 else value[:2] + _shape(draws, value[2:4]) + body
    if kind.startswith("given:"):
        _, script, gender = kind.split(":")
        if attempt < 4:
            pool = GIVEN[script, gender]
            return pool[draws.below(len(pool))].lower()
        ending = ("а" if script == "cyrillic" else "a") if gender == "f" else ""
        return _syllables(draws, script, 2 + attempt // 8) + ending
    if kind.startswith("family:"):
        return _syllables(draws, kind.split(":")[1], 3 + attempt // 8) + _family_ending(value)
    return _shape(draws, value + ("a" if kind == "hex" else "x") * longer, kind == "hex")


def _family_ending(value: str) -> str:
    """Cyrillic family names tell the gender by their ending."""
    if value.endswith(("ова", "ева", "ёва", "ина", "ая")):
        return "ова"
    return "ов" if value.endswith(("ов", "ев", "ёв", "ин", "ий")) else ""


def _syllables(draws: Draws, script: str, count: int) -> str:
    return "".join(SYLLABLES[script][draws.below(len(SYLLABLES[script]))] for _ in range(count))


def rendered(kind: str, mention: str, value: str) -> str:
    """value written as the mention was: its separators, its case."""
    if kind in ("phone", "card", "national", "iban"):
        left = iter(value)
        return "".join(next(left) if c.isalnum() else c for c in mention)
    if ":" in kind:
        return value.upper() if mention.isupper() and len(mention) > 1 else "-".join(x[:1].upper() + x[1:] for x in value.split("-"))
    if kind in ("email", "hex"):
        if mention.isupper():
            return value.upper()
        if len(value) == len(mention):
            return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, value, strict=True))
    return value
