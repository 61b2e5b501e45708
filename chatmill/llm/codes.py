"""Texts as arrays of code points: folding, words and rolling hashes for whole batches at a time."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

#: Code points handled one at a time stay under this many for each batch of arrays (about 60 bytes each).
CHUNK_CHARS = 1 << 20
DELETED = np.uint32(0xFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# Letters of other scripts that look like Latin ones, in lower case (upper case forms included where only those look alike).
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "є": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ү": "y", "ѵ": "v", "ԝ": "w", "х": "x", "й": "и",
    "α": "a", "β": "b", "ε": "e", "η": "h", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "y", "χ": "x", "ς": "c",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "օ": "o", "ս": "u",
}


def fold_char(c: str) -> str:
    """A letter or digit without case, accents and script; "" for what is invisible, " " for anything between words."""
    kind = unicodedata.category(c)
    if kind in ("Cf", "Mn", "Me") or c in "ᅟᅠㅤ⠀":
        return ""
    plain = unicodedata.normalize("NFKD", c.lower())
    plain = "".join(x for x in plain if unicodedata.category(x) not in ("Mn", "Me", "Cf"))
    plain = LOOKALIKES.get(plain, plain)
    if len(plain) == 1 and unicodedata.category(plain)[0] in "LN":
        return plain
    return c if kind[0] in "LN" else " "


@lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """For each code point of the first two planes its folded code, 0 between words, DELETED if invisible."""
    table = np.zeros(0x20000, np.uint32)
    for cp in range(0x20000):
        if 0xD800 <= cp < 0xE000:
            continue
        f = fold_char(chr(cp))
        table[cp] = DELETED if f == "" else 0 if f == " " else ord(f)
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _ODD
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


BASE = 0x2545F4914F6CDD1D
#: Odd numbers have inverses modulo 2**64.
INVERSE = pow(BASE, -1, 1 << 64)
BASE2 = 0xD1342543DE82EF95
INVERSE2 = pow(BASE2, -1, 1 << 64)


@lru_cache(maxsize=8)
def powers(n: int, base: int = BASE) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(base))
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)


def size_up(n: int) -> int:
    return 1 << max(10, int(n).bit_length())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: Sequence[str | None], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most so many characters in all; a longer text is a range of its own."""
    begin = total = 0
    for k, t in enumerate(texts):
        n = len(t) + 1 if t else 1
        if total and total + n > most:
            yield begin, k
            begin, total = k, 0
        total += n
    if begin < len(texts):
        yield begin, len(texts)


class Words:
    """Folded words of several texts: hash of each word, its text, and where its letters lie."""

    def __init__(self, texts: Sequence[str | None]):
        texts = [t or "" for t in texts]
        raw = code_points("\0".join(texts))
        table = fold_table()
        codes = np.where(raw < len(table), table[np.minimum(raw, len(table) - 1)], 0).astype(np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        shown = codes != DELETED
        self.letters = codes[shown]
        inside = np.concatenate(([False], self.letters != 0, [False]))
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        self.begin, self.end = turn[::2], turn[1::2]
        self.raw = raw
        #: Where each word begins in the joined texts.
        self.place = np.flatnonzero(shown)[self.begin] if len(self.begin) else np.zeros(0, np.int64)
        self.text = np.searchsorted(ends, self.place, side="right")
        n = size_up(len(self.letters) + 1)
        p, inverse = powers(n), powers(n, INVERSE)
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.letters) * p[: len(self.letters)], dtype=np.uint64)))
            self.hash = mix((total[self.end] - total[self.begin]) * inverse[self.begin])

    def spelled(self, first: int, count: int) -> list[bytes]:
        return [self.letters[self.begin[k] : self.end[k]].tobytes() for k in range(first, first + count)]
