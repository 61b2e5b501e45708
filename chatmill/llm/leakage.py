"""Test items that leaked into training text, by multi-pattern search after Wu and Manber.

The alphabet is words, folded for case, accents, look-alike letters and invisible characters. Patterns are all
windows of eight words of an item's body. A table gives, for the block of the last two words under the window, how
far the window can move on; where it cannot, the bucket of that block names the patterns that end in it, and those
are compared word for word, letter for letter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chatmill.llm.codes import Words, chunks, mix

WINDOW = 8
#: Entries of the shift table for each block of a pattern, so that most blocks of a text are in none.
SPARSE = 16
MOST_TABLE_BITS = 26
#: Windows moved at the same time.
LANES = 4096
#: Characters of item bodies that are sent to every task at once; a larger set is searched for in parts of this size.
PART_CHARS = 8 << 20


class Matcher:
    """Tables for the windows of a set of items."""

    def __init__(self, bodies: Sequence[str | None], window: int = WINDOW):
        self.window = window
        words = Words(bodies)
        n = len(words.hash)
        first = np.arange(max(0, n - window + 1))
        first = first[words.text[first] == words.text[first + window - 1]] if n >= window else first[:0]
        self.item = words.text[first]
        self.words = words
        self.first = first
        self.bits = min(MOST_TABLE_BITS, max(12, int(len(first) * window * SPARSE).bit_length()))
        self.shift = np.full(1 << self.bits, window - 1, np.int8)
        for j in range(window - 1, 0, -1):  # the block of words j-1 and j of a pattern lets the window move by window-1-j
            if len(first):
                block = self._block(words.hash[first + j - 1], words.hash[first + j])
                self.shift[block] = np.minimum(self.shift[block], window - 1 - j)
        last = self._suffix(words.hash, first + window - 1) if len(first) else np.zeros(0, np.uint64)
        order = np.argsort(last, kind="stable")
        self.suffix, self.order = last[order], order

    def _block(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((a * np.uint64(3) + b) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _suffix(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(hashes[at - 1] * np.uint64(3) + hashes[at])

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Text and item numbers of all occurrences, each once."""
        n, w = len(words.hash), self.window
        none = np.zeros(0, np.int64)
        if n < w or not len(self.first):
            return none, none
        lanes = min(LANES, max(1, (n - w + 1) // 16))
        stop = np.linspace(w - 1, n, lanes + 1).astype(np.int64)
        at, stop = stop[:-1].copy(), stop[1:]
        stuck = []
        while len(at):
            move = self.shift[self._block(words.hash[at - 1], words.hash[at])]
            zero = move == 0
            if zero.any():
                stuck.append(at[zero])
            at = at + np.maximum(move, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not stuck:
            return none, none
        at = np.concatenate(stuck)
        at = at[words.text[at] == words.text[at - w + 1]]
        suffix = self._suffix(words.hash, at)
        low, high = np.searchsorted(self.suffix, suffix, "left"), np.searchsorted(self.suffix, suffix, "right")
        many = high - low
        at, low = np.repeat(at, many), np.repeat(low, many)
        pattern = self.order[low + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)] if len(at) else none
        for j in range(w):
            same = words.hash[at - w + 1 + j] == self.words.hash[self.first[pattern] + j]
            at, pattern = at[same], pattern[same]
        sure = [words.spelled(a - w + 1, w) == self.words.spelled(self.first[p], w) for a, p in zip(at, pattern, strict=True)]
        at, pattern = at[sure], pattern[sure]
        found = np.unique(np.stack([words.text[at], self.item[pattern]], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        return found[:, 0], found[:, 1]


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", body: str = "body", window: int = WINDOW) -> DataFrame:
    """A row (``doc_id``, ``item_id``) for each document that carries ``window`` consecutive words of an item's body.

    Case, accents, punctuation, spacing, invisible characters and look-alike letters don't count. Items with fewer
    words, null bodies and null item ids are never found; null and empty texts carry nothing. Documents repeated
    under one id give one row for each copy and item; further columns are ignored. Nothing is shuffled: the items, a held-out
    test set, go to every task, and one pass over the texts finds them. A set of more than PART_CHARS characters is cut into
    parts by the hashes of the items' ids, each with a pass of its own.
    """
    spark = documents.sparkSession
    wanted = items.select(F.col(item_id).alias("i"), F.col(body).alias("b")).where("i is not null and b is not null")
    chars = wanted.agg(F.sum(F.length("b")).alias("n")).first().n or 0
    parts = max(1, -(-chars // PART_CHARS))
    kinds = f"`{doc_id}` {documents.schema[doc_id].dataType.simpleString()}, `{item_id}` {items.schema[item_id].dataType.simpleString()}"
    texts = documents.select(doc_id, text)
    out: DataFrame | None = None
    for part in range(parts):
        found = texts.mapInArrow(_searched(spark, wanted.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == part), window, [doc_id, item_id]), kinds)
        out = found if out is None else out.unionByName(found)
    return out


def _searched(spark: SparkSession, items: DataFrame, window: int, names: list[str]):
    """The search for a part of the items, as a function on batches of identifiers and texts."""
    rows = sorted(((r.i, r.b) for r in items.collect()), key=lambda r: (r[0], r[1]))
    kind = items.schema["i"].dataType
    sent = spark.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher([b for _, b in sent.value], window)
        ids = pa.array([i for i, _ in sent.value], to_arrow_type(kind))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                text, item = matcher.search(Words(texts[a:b]))
                if len(text):
                    # copies of an item under one id count once
                    pairs = pa.table([batch.column(0).take(pa.array(text + a)), ids.take(pa.array(item)), pa.array(text)], [*names, "_row"])
                    yield from pairs.group_by([*names, "_row"]).aggregate([]).select(names).to_batches()

    return run
