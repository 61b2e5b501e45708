"""Personal information in free text, found by a semi-Markov conditional random field over whole spans.

A text is a row of tokens. Every stretch of at most ``MOST_TOKENS`` tokens is scored as a whole for every type of entity: the
tokens inside and their neighbours in pairs, those before and after, words of context, the number of tokens and of digits, and
the pattern of the whole stretch. Dynamic programming chooses the stretches that don't overlap with the greatest sum of
scores, settling boundaries and types together; what is in no stretch scores nothing. Nothing but this model decides.

Scores are sums over tables, so those of all stretches of many texts come from running totals. The weights are trained here
by gradient ascent on the conditional likelihood, on sentences that a seeded generator writes; no text of the data is
needed for it.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.llm.lexicon import CLASSES, CONTEXT_BITS, DOT, HELD, INITIALS, KINDS, classify, training_sentences

#: The longest entity, in tokens.
MOST_TOKENS = 20
MOST_NAME = 8
#: Tokens scored at the same time.
CHUNK_TOKENS = 40_000
PAIR_BITS = PATTERN_BITS = 16
DIGITS = 16
#: Tokens before an entity whose words of context count.
NEAR = 5
#: Words whose class is remembered.
HELD_WORDS = 400_000

TOKEN = re.compile(r"\s*(?:[^\W\d_]+|\d+|[^\w\s]|_)")
_ODD = re.compile("[  -‏‪- ⁠-⁤﻿­！-～　‐-‒−]")
_SCRIPTS = re.compile(r"[а-яё][a-z]|[a-z][а-яё]", re.I)
_PLAIN = {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | dict.fromkeys([0xA0, 0x3000, 0x202F, *range(0x2000, 0x200B)], " ") | dict.fromkeys([0x2010, 0x2011, 0x2012, 0x2212], "-")
_UNSEEN = re.compile("[​-‏‪-‮⁠-⁤﻿­]")
_TO_CYRILLIC = str.maketrans("aceopxyABCEHKMOPTXy", "асеорхуАВСЕНКМОРТХу")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def plain(text: str) -> tuple[str, list[int] | None]:
    """The text with look-alikes made plain, and where each character stood if some were left out."""
    where = None
    if text.isascii():
        return text, None
    if _ODD.search(text):
        text = text.translate(_PLAIN)
        if _UNSEEN.search(text):
            where = [k for k, c in enumerate(text) if not _UNSEEN.match(c)]
            text = "".join(text[k] for k in where)
    if _SCRIPTS.search(text):
        text = _WORD.sub(lambda m: m[0].translate(_TO_CYRILLIC) if re.search("[а-яё]", m[0], re.I) and re.search("[a-z]", m[0], re.I) else m[0], text)
    return text, where


class _Codes(dict):
    """Class of a token (with its leading space), four times, plus 1 after a space or 2 after a line break; digits in the upper part."""

    def __missing__(self, token: str) -> int:
        bare = token.lstrip()
        flag = 0 if len(bare) == len(token) else 2 if "\n" in token[: len(token) - len(bare)] else 1
        if len(self) > HELD_WORDS:
            self.clear()
        code = self[token] = classify(bare) * 4 + flag + (len(bare) << 16 if bare.isdigit() else 0)
        return code


_CODES = _Codes()
_BORDER = 0  # the class between texts


class Tokens:
    """The tokens of several texts in one row, two border tokens before, between and after them."""

    def __init__(self, texts: Sequence[str]):
        codes: list[int] = []
        self.begin = []
        for t in texts:
            codes += (0, 0)
            self.begin.append(len(codes))
            codes += map(_CODES.__getitem__, TOKEN.findall(t))
        codes += (0, 0)
        raw = np.array(codes, np.int64)
        self.n = len(raw)
        self.cls, self.flag, self.digits = raw >> 2 & 0x3FFF, raw & 3, raw >> 16
        with np.errstate(over="ignore"):
            mixed = self.cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            after = (self.cls * 4 + self.flag).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            #: Pair of each token with the one before it.
            self.pair = np.zeros(self.n, np.int64)
            self.pair[1:] = ((mixed[:-1] ^ (after[1:] >> np.uint64(7)) * np.uint64(0x165667B19E3779F9)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            self.value = (self.cls * 4 + self.flag + 1).astype(np.uint64)
            self.first = (self.cls * 4 + 1).astype(np.uint64)
        bits = CONTEXT_BITS[self.cls]
        self.near = np.zeros(self.n, np.int64)
        for k in range(1, NEAR + 1):
            self.near[k:] |= bits[:-k]
        self.inside = self.cls != _BORDER
        self.total = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.digits)))
        #: Running counts of the tokens that make a mail address, a name or a place, and of words for digits.
        telling = [h[self.cls] for h in HELD]
        telling[1][:-1][INITIALS[self.cls[:-1]] & (self.cls[1:] != DOT)] = 0
        self.held = [np.concatenate((np.zeros(1, np.int64), np.cumsum(h))) for h in telling]
        self.borders = np.concatenate((np.zeros(1, np.int64), np.cumsum(~self.inside)))

    def stretches(self, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each type the stretches of a length that can be of it, their digits, and the telling tokens they hold (none, one, more).

        They lie in one text; a mail address holds a sign or word for "at", a name a given name, patronymic or initial with a full stop,
        an address a digit, and the numbers as many digits, or words for digits, as the shortest of them.
        """
        n = self.n - length + 1
        digits = self.total[length:] - self.total[:n]
        mail, name, place, said = (h[length:] - h[:n] for h in self.held)
        inside = self.borders[length:] == self.borders[:n]
        can = (mail > 0, (digits >= 7) | (said >= 7), digits >= 6, digits > 0, (name > 0) & (length <= MOST_NAME))
        for k, some in enumerate(can):
            at = np.flatnonzero(inside & some)
            if len(at):
                yield k, at, np.minimum(digits[at], DIGITS - 1), np.minimum(mail[at], 2) * 9 + np.minimum(name[at], 2) * 3 + np.minimum(place[at], 2)

    def patterns(self, before: np.ndarray | None, length: int) -> np.ndarray:
        """Hashes of the stretches' patterns, from those one token shorter."""
        with np.errstate(over="ignore"):
            if before is None:
                return self.first.copy()
            n = self.n - length + 1
            return before[:n] * np.uint64(0x9E3779B97F4A7C15) + self.value[length - 1 :]


def _bucket(patterns: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (patterns ^ patterns >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(64 - PATTERN_BITS)).astype(np.int64)


_SHAPES = {"before": len(CLASSES), "before2": len(CLASSES), "first": len(CLASSES), "last": len(CLASSES), "after": len(CLASSES), "after2": len(CLASSES), "inside": len(CLASSES), "enter": 1 << PAIR_BITS, "leave": 1 << PAIR_BITS, "pair": 1 << PAIR_BITS, "near": 8, "length": MOST_TOKENS, "digits": DIGITS, "holds": 27, "pattern": 1 << PATTERN_BITS}
Model = dict[str, np.ndarray]


def _near_table(model: Model) -> np.ndarray:
    masks = np.arange(256)
    return np.stack([(masks >> g & 1) for g in range(8)], 1).astype(np.float32) @ model["near"]


def _ends(t: Tokens, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What beginning at a token, ending at it, and holding the tokens up to it score: a row for each type."""
    c = t.cls
    begin = m["first"][c] + m["enter"][t.pair] + _near_table(m)[t.near]
    begin[1:] += m["before"][c[:-1]]
    begin[2:] += m["before2"][c[:-2]]
    end = m["last"][c].copy()
    end[:-1] += m["after"][c[1:]] + m["leave"][t.pair[1:]]
    end[:-2] += m["after2"][c[2:]]
    pair = m["pair"][t.pair]
    held = np.concatenate((np.zeros((1, len(KINDS))), np.cumsum(m["inside"][c] + pair, 0, dtype=np.float64)))
    # the pair with the token before lies half outside
    return np.ascontiguousarray((begin - pair - held[:-1]).T), np.ascontiguousarray((end + held[1:]).T), held


def scores(t: Tokens, m: Model) -> Iterator[tuple[int, int, np.ndarray, tuple[np.ndarray, ...], np.ndarray]]:
    """For each length and type: both, where such stretches begin, their digits, tokens held and patterns, and their scores."""
    begin, end, _ = _ends(t, m)
    by_kind = {name: np.ascontiguousarray(m[name].T) for name in ("digits", "holds", "pattern")}
    pattern = None
    for length in range(1, min(MOST_TOKENS, t.n) + 1):
        pattern = t.patterns(pattern, length)
        for k, at, digits, holds in t.stretches(length):
            bucket = _bucket(pattern[at])
            s = begin[k, at] + end[k, at + (length - 1)]
            s += by_kind["pattern"][k, bucket] + by_kind["digits"][k, digits] + by_kind["holds"][k, holds] + m["length"][length - 1, k]
            yield length, k, at, (digits, holds, bucket), s


def best(spans: list[tuple[int, int, int]], values: list[float]) -> list[tuple[int, int, int]]:
    """The spans (begin, end, type) that don't overlap with the greatest sum; only spans worth more than nothing can be in it."""
    order = sorted(range(len(spans)), key=lambda k: (spans[k][1], spans[k][0], spans[k][2]))
    ends = [spans[k][1] for k in order]
    total, link = [0.0], [-1]
    for n, k in enumerate(order):
        j = bisect_right(ends, spans[k][0], 0, n)
        value = total[j] + values[k]
        better = value > total[n] + 1e-6
        total.append(value if better else total[n])
        link.append(j if better else -1)
    out, n = [], len(order)
    while n:
        if link[n] >= 0:
            out.append(spans[order[n - 1]])
            n = link[n]
        else:
            n -= 1
    return out[::-1]


def marginals(worth: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of all segmentations' sums, and the probability of each stretch (text, begin, length, type), by forward and backward sums."""
    many, steps, lengths, _ = worth.shape
    top = worth.max(3)
    whole = top + np.log(np.exp(worth - top[..., None]).sum(3))
    forward, backward = np.full((many, steps + 1), -1e30), np.full((many, steps + 1), -1e30)
    forward[:, 0] = 0
    rows = np.arange(many)
    for t in range(1, steps + 1):
        reach = min(t, lengths)
        at = np.arange(t - 1, t - 1 - reach, -1)
        part = np.concatenate((forward[:, t - 1 : t], forward[:, at] + whole[:, at, np.arange(reach)]), 1)
        m = part.max(1)
        forward[:, t] = m + np.log(np.exp(part - m[:, None]).sum(1))
    backward[rows, size] = 0
    for t in range(steps - 1, -1, -1):
        reach = min(steps - t, lengths)
        part = np.concatenate((backward[:, t + 1 : t + 2], whole[:, t, :reach] + backward[:, t + 1 : t + 1 + reach]), 1)
        m = part.max(1)
        inner = m + np.log(np.exp(part - m[:, None]).sum(1))
        backward[:, t] = np.where(t < size, inner, backward[:, t])
    z = forward[rows, size]
    after = np.full((many, steps, lengths), -1e30)
    for n in range(min(lengths, steps)):
        after[:, : steps - n, n] = backward[:, n + 1 : steps + 1]
    return z, np.exp(np.minimum(forward[:, :steps, None, None] + worth + after[..., None] - z[:, None, None, None], 0))


def _gradient(texts: list[str], gold: list[list[tuple[int, int, int]]], m: Model) -> tuple[float, Model]:
    """Log-likelihood of the spans (first token, token after, type) of the texts, and its gradient."""
    t = Tokens(texts)
    begin = np.array(t.begin)
    size = np.array([*(begin[1:] - 2), t.n - 2]) - begin
    steps = max(1, int(size.max()))
    at = np.minimum(begin[:, None] + np.arange(steps), t.n - 1)
    dense = np.full((t.n, MOST_TOKENS, len(KINDS)), -1e9)
    parts = []
    for length, k, where, whole, s in scores(t, m):
        parts.append((length, k, where, whole))
        dense[where, length - 1, k] = s
    real = np.arange(steps) < size[:, None]
    worth = np.where(real[:, :, None, None], dense[at], -1e9)
    z, p = marginals(worth, size)
    d = -p
    value = -z.sum()
    for b, spans in enumerate(gold):
        for i, j, k in spans:
            d[b, i, j - i - 1, k] += 1
            value += worth[b, i, j - i - 1, k]
    flat = np.zeros((t.n, MOST_TOKENS, len(KINDS)))
    flat[at[real]] = d[real]
    g = {name: np.zeros_like(x, np.float64) for name, x in m.items()}
    kinds = range(len(KINDS))

    def add(name: str, index: np.ndarray, weights: np.ndarray) -> None:
        for k in kinds:
            g[name][:, k] += np.bincount(index, weights[:, k], minlength=len(g[name]))

    c = t.cls
    start = flat.sum(1)
    stop, cover = np.zeros((t.n, len(KINDS))), np.zeros((t.n + 1, len(KINDS)))
    cover[:-1] += start
    for n in range(min(MOST_TOKENS, t.n)):
        stop[n:] += flat[: t.n - n, n]
        cover[n + 1 :] -= flat[: t.n - n, n]
    cover = np.cumsum(cover[:-1], 0)
    add("first", c, start)
    add("enter", t.pair, start)
    add("before", c[:-1], start[1:])
    add("before2", c[:-2], start[2:])
    for b in range(8):
        g["near"][b] += start[(t.near >> b & 1) == 1].sum(0)
    add("last", c, stop)
    add("after", c[1:], stop[:-1])
    add("leave", t.pair[1:], stop[:-1])
    add("after2", c[2:], stop[:-2])
    add("inside", c, cover)
    add("pair", t.pair, cover - start)
    g["length"] += flat.sum(0)
    for length, k, where, whole in parts:
        some = np.abs(flat[where, length - 1, k]) > 1e-4
        for name, index in zip(("digits", "holds", "pattern"), whole, strict=True):
            np.add.at(g[name][:, k], index[some], flat[where[some], length - 1, k])
    return value, g


@lru_cache(maxsize=4)
def train(count: int = 6000, rounds: int = 8, rate: float = 0.35, decay: float = 0.02, seed: int = 11, leave_out: tuple[str, ...] = ()) -> Model:
    """Weights that maximise the likelihood of the training sentences' spans, less a square penalty.

    ``leave_out`` names forms the generator then never uses, for measuring how others carry over to them.
    """
    data = []
    for text, spans in training_sentences(count, seed, leave_out):
        clean, _ = plain(text)
        places = [(m.end() - len(m[0].lstrip()), m.end()) for m in TOKEN.finditer(clean)]
        first, last = {a: n for n, (a, _) in enumerate(places)}, {b: n + 1 for n, (_, b) in enumerate(places)}
        gold = [(first[a], last[b], KINDS.index(k)) for a, b, k in spans]
        if all(j - i <= MOST_TOKENS for i, j, _ in gold):
            data.append((clean, gold, len(places)))
    data.sort(key=lambda x: x[2])
    blocks = [data[k : k + 160] for k in range(0, len(data), 160)]
    model = {name: np.zeros((n, len(KINDS)), np.float32) for name, n in _SHAPES.items()}
    model["first"] -= 1.0
    squares = {name: np.full_like(x, 1e-3) for name, x in model.items()}
    r = random.Random(5)
    for _ in range(rounds):
        r.shuffle(blocks)
        for block in blocks:
            _, grad = _gradient([x[0] for x in block], [x[1] for x in block], model)
            for name, g in grad.items():
                g = (g - decay * model[name]).astype(np.float32)
                squares[name] += g * g
                model[name] += rate * g / np.sqrt(squares[name])
    return model


def find_many(texts: Sequence[str | None], model: Model) -> list[list[tuple[int, int, str]]]:
    """Begin, end and type of the personal spans of each text, in order."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    cleaned = [plain(t) if t else ("", None) for t in texts]
    at = 0
    while at < len(texts):
        upto, held = at, 0
        while upto < len(texts) and (held == 0 or held + len(cleaned[upto][0]) // 3 < CHUNK_TOKENS):
            held += len(cleaned[upto][0]) // 3 + 2
            upto += 1
        tokens = Tokens([c for c, _ in cleaned[at:upto]])
        begin = np.array(tokens.begin)
        found: dict[int, list[tuple[int, int, int, float]]] = {}
        for length, k, where, _, s in scores(tokens, model):
            hit = np.flatnonzero(s > 0)
            if len(hit):
                first = where[hit]
                for i, v, b in zip(first.tolist(), s[hit].tolist(), (np.searchsorted(begin, first, side="right") - 1).tolist(), strict=True):
                    found.setdefault(b, []).append((i - tokens.begin[b], i - tokens.begin[b] + length, k, v))
        for b, spans in found.items():
            clean, where = cleaned[at + b]
            places = [(m.end() - len(m[0].lstrip()), m.end()) for m in TOKEN.finditer(clean)]
            for i, j, k in best([x[:3] for x in spans], [x[3] for x in spans]):
                a, e = places[i][0], places[j - 1][1]
                out[at + b].append((a, e, KINDS[k]) if where is None else (where[a], where[e - 1] + 1, KINDS[k]))
        at = upto
    return out


def find(text: str | None, model: Model) -> list[tuple[int, int, str]]:
    return find_many([text], model)[0]


def masked(text: str, spans: Sequence[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, k in spans:
        out += [text[at:a], f"[{k}]"]
        at = b
    return "".join([*out, text[at:]])


def mask_personal(rows: DataFrame, keys: Sequence[str], column: str, keep_clean: bool = True) -> DataFrame:
    """The key columns, ``text_masked`` and ``pii_kinds`` (sorted types found, each once) for one text column.

    Every row is judged by itself, whole; nothing is shuffled. Null stays null with no types, texts without personal
    information stay as they are. Repeated rows give repeated rows, keys may be null. With ``keep_clean=False`` only
    rows in which something was found come out.
    """
    weights = rows.sparkSession.sparkContext.broadcast(train())
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys), "text_masked string", "pii_kinds array<string>"])
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = weights.value
        for batch in batches:
            # repeated texts are judged once a batch
            coded = batch.column(width).dictionary_encode()
            texts = coded.dictionary.to_pylist()
            spans = find_many(texts, model)
            row, out, kinds = [], [], []
            for k, n in enumerate(coded.indices.to_pylist()):
                some = spans[n] if n is not None else []
                if keep_clean or some:
                    row.append(k)
                    out.append(None if n is None else masked(texts[n], some) if some else texts[n])
                    kinds.append(sorted({x[2] for x in some}))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(take) for j in range(width)), pa.array(out, pa.string()), pa.array(kinds, pa.list_(pa.string()))], [*keys, "text_masked", "pii_kinds"])

    return rows.select(*keys, column).mapInArrow(run, schema)


def personal_fields(fields: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """``field_name``, the keys and ``pii_kind`` of each field that holds such information; copies count once."""
    out: DataFrame | None = None
    for rows, keys, column in fields:
        found = mask_personal(rows, keys, column, keep_clean=False).select(F.lit(column).alias("field_name"), *keys, F.explode("pii_kinds").alias("pii_kind"))
        out = found if out is None else out.unionByName(found)
    return out.distinct()
