"""Made-up secrets and strings that only look like them, to learn from: labels that no pattern has given."""

from __future__ import annotations

import random
import string
import uuid
from collections.abc import Callable

_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
_ALL = _LOWER + _UPPER + _DIGITS
_PARTS = (
    "ab ance ation ber che con der ein ent er est ge heit ing ion ist keit le lich ly ment ness on or ous pre re sch ste"
    " sub tion tra ung ver with"
).split()
_NAMES = "api app batch cache client config data error file index item job key log main node page queue row size table user view".split()


def _draw(r: random.Random, letters: str, low: int, high: int | None = None) -> str:
    return "".join(r.choices(letters, k=r.randint(low, high or low)))


def _mixed(r: random.Random, letters: str, low: int, high: int) -> str:
    """Random characters, at least one of them a digit."""
    own = list(_draw(r, letters, low, high))
    own[r.randrange(len(own))] = r.choice(_DIGITS)
    return "".join(own)


def _word(r: random.Random, least: int) -> str:
    own = ""
    while len(own) < least:
        own += r.choice(_PARTS)
    return own


def _name(r: random.Random, mark: str) -> str:
    own = [r.choice(_NAMES) for _ in range(r.randint(3, 5))]
    own.insert(r.randint(1, len(own)), str(r.randint(0, 99)))
    return mark.join(own).ljust(12, "s")


#: Kinds of keys, none of which has to stand behind a telling name.
SECRETS: dict[str, Callable[[random.Random], str]] = {
    "base64": lambda r: _mixed(r, _ALL + "+/", 32, 44) + r.choice(["", "=", "=="]),
    "long base64": lambda r: _mixed(r, _ALL + "+/", 60, 160),
    "letters and digits": lambda r: _mixed(r, _ALL, 16, 40),
    "url-safe": lambda r: _mixed(r, _ALL + "-_", 22, 48),
    "upper hex": lambda r: _mixed(r, _DIGITS + "ABCDEF", 24, 64),
    "base32": lambda r: _mixed(r, _UPPER + "234567", 16, 32),
    "prefixed": lambda r: f"{_draw(r, _LOWER, 2, 4)}_{r.choice(['', 'live_', 'test_'])}{_mixed(r, _ALL, 24, 36)}",
    "in parts": lambda r: f"xo{r.choice(_LOWER)}b-{_draw(r, _DIGITS, 10, 12)}-{_mixed(r, _ALL, 20, 26)}",
    "signed": lambda r: f"eyJ{_mixed(r, _ALL + '-_', 30, 80)}",
    "short": lambda r: _mixed(r, _ALL, 12, 16),
}

#: What is as long and means no harm.
CLEAN: dict[str, Callable[[random.Random], str]] = {
    "word": lambda r: _word(r, 20),
    "capital word": lambda r: _word(r, 20).capitalize(),
    "shouted word": lambda r: _word(r, 20).upper(),
    "joined words": lambda r: "-".join(_word(r, 4) for _ in range(r.randint(4, 6))),
    "syllables": lambda r: _word(r, r.randint(20, 90)),
    "snake name": lambda r: _name(r, "_"),
    "title": lambda r: _name(r, "-"),
    "path": lambda r: "/" + _name(r, "/"),
    "camel name": lambda r: "".join(w.capitalize() for w in _name(r, " ").split()).ljust(12, "s"),
    "number": lambda r: _draw(r, _DIGITS, 12, 15),
    "date": lambda r: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}T{r.randint(0, 23):02}",
    "phone": lambda r: f"+{r.randint(1, 99)}-{_draw(r, _DIGITS, 3)}-{_draw(r, _DIGITS, 3)}-{_draw(r, _DIGITS, 4)}",
    "uuid": lambda r: str(uuid.UUID(int=r.getrandbits(128), version=4)),
    "version": lambda r: f"v{r.randint(0, 9)}_{r.randint(0, 20)}_{r.randint(0, 99)}-{r.choice(['alpha', 'beta', 'release'])}",
    "rule": lambda r: r.choice("-=_") * r.randint(20, 70),
    "page": lambda r: f"{r.choice(_NAMES)}/{r.randint(1000, 9999)}/{r.choice(_NAMES)}{r.randint(1, 9)}",
}

_BEFORE = ("", "the key is ", "bearer ", "auth: ", "use ", "see ", "id=", "value: ", '"', "(", "\n", "key=", "https://")


def findings(count: int, seed: int = 5) -> list[tuple[bytes, int, int, bool, str]]:
    """Texts with one string each: the text, where the string starts and ends, whether it is a secret, and its kind.

    Half are secrets; both halves stand behind the same words, so that the
    string itself has to tell.
    """
    r, out = random.Random(seed), []
    for n in range(count):
        secret = n % 2 == 0
        kinds = SECRETS if secret else CLEAN
        kind = list(kinds)[n // 2 % len(kinds)]
        own = kinds[kind](r)
        before = " ".join(_word(r, r.randint(1, 8)) for _ in range(r.randint(0, 5))) + " " + r.choice(_BEFORE)
        behind = r.choice(["", " ", "\n", '"', ". ", ", ", ")"]) + " ".join(_word(r, r.randint(1, 8)) for _ in range(3))
        text = f"{before}{own}{behind}" if behind[:1] not in _ALL else f"{before}{own} {behind}"
        out.append((text.encode(), len(before.encode()), len((before + own).encode()), secret, kind))
    return out
