"""Exact and near duplicates of texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatmill.functions.text import lower_words, normalized, onward, stripped
from chatmill.operators.redelivery import deduplicate_deliveries
from chatmill.plans.scratch import Scratch

# Parameters of the min-hash family.
PERMUTATIONS, BANDS = 128, 32
PRIME = 4_294_967_311


def _text_key(text: str, least: int) -> Column:
    """Hash of the normalized text; null for texts that are too short to be anybody's copy."""
    norm = normalized(F.col(text))
    return F.when(F.length(norm) >= least, F.md5(norm))


def exact_duplicates(rows: DataFrame, text: str, order: Sequence[str], least: int = 15, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``rows`` without later copies of a text; texts that normalize to fewer than ``least`` characters all stay.

    Copies are rows whose text normalizes alike; the first in ``order`` stays (``order`` must have no ties or nulls for a
    defined result). Only hashes and order columns are shuffled to find the copies. They are sent to the rows where they fit
    ``broadcast_bytes``; else rows are matched with them by their order columns, which moves the rows: for large tables use
    ``exact_duplicates_in_table``.
    """
    at = F.struct(*[F.col(c) for c in order])
    keyed = Scratch(rows.sparkSession, "exact").save("keyed", rows.select(_text_key(text, least).alias("_key"), at.alias("_at")).where("_key is not null"))
    first = keyed.groupBy("_key").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = keyed.join(first, "_key").where(~F.col("_at").eqNullSafe(F.col("_first"))).select("_at")
    copies = Scratch(rows.sparkSession, "copies").save("copies", copies)
    small = copies.count() * 24 * (1 + len(order)) <= broadcast_bytes
    return rows.withColumn("_at", at).join(F.broadcast(copies) if small else copies, "_at", "left_anti").drop("_at")


def exact_duplicates_in_table(spark: SparkSession, path: str, text: str, order: Sequence[str], least: int = 15, columns: Sequence[str] | None = None) -> DataFrame:
    """``exact_duplicates`` of a Parquet table, of which ``columns`` (all by default) are read without being shuffled.

    Hashes, order and file positions are shuffled; losing rows become deletion vectors of their files.
    """
    kept = deduplicate_deliveries(spark, path, [_text_key(text, least)], order, columns)
    return kept.drop("redelivered")


def shingles(text: Column, size: int = 3) -> Column:
    """Set of runs of ``size`` words in lower case; a shorter text is one shingle, a wordless one has none."""
    w = lower_words(text)
    joined = w
    for k in range(2, size + 1):
        joined = F.zip_with(joined, onward(w, k), lambda a, b: F.concat_ws(" ", a, b))
    whole = F.slice(joined, 1, F.greatest(F.size(w) - (size - 1), F.lit(1)))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < size, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(whole))


_WORDS = re.compile(r"[^\W]+")


class _Shingler:
    """Sets of shingle hashes: words are hashed once each, shingles are combined from them."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[str, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        words = _WORDS.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.int64)
        if len(self.known) > 500_000:
            self.known.clear()
        out = np.empty(len(words), np.uint64)
        for k, w in enumerate(words):
            h = self.known.get(w)
            if h is None:
                h = self.known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            out[k] = h
        size = min(self.size, len(words))
        with np.errstate(over="ignore"):
            total = np.full(len(out) - size + 1, size, np.uint64)
            for k in range(size):
                total = total * np.uint64(0x9E3779B97F4A7C15) + out[k : len(out) - size + 1 + k]
                total ^= total >> np.uint64(31)
        return np.unique(total.view(np.int64))


def shingle_hashes(text: Column, size: int = 5) -> Column:
    """The hashes of the text's shingles in order; equal for texts with equal sets of shingles, empty without words."""

    def run(texts: pd.Series) -> pd.Series:
        shingler = _Shingler(size)
        return texts.map(shingler.hashes)

    return F.pandas_udf(run, "array<long>")(text)


def _least(hashes: np.ndarray, permutations: int) -> np.ndarray:
    """For each permutation the least image of the hashes."""
    i = np.arange(1, permutations + 1, dtype=np.uint64)[:, None]
    h = hashes.view(np.uint64) & np.uint64(0xFFFFFFFF)
    out = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), 2048):
        x = h[None, k : k + 2048] * (np.uint64(10007) * i + np.uint64(34229)) + (np.uint64(49999) * i + np.uint64(88123))
        x -= x // np.uint64(PRIME) * np.uint64(PRIME)
        np.minimum(out, x.min(1), out=out)
    return (out & np.uint64(0xFFFFFFFF)).view(np.int64)


def signatures(rows: DataFrame, keys: Sequence[str], text: str, size: int = 5, permutations: int = PERMUTATIONS) -> DataFrame:
    """The keys, ``set_key``, ``n`` and ``signature``: for each permutation the least hash of the text's shingles (all 0 without words).

    ``set_key`` is equal for equal sets of shingles only, ``n`` is the size of the set. Each row is made by itself, in Arrow
    batches; nothing is shuffled.
    """

    def run(texts: pd.Series) -> pd.Series:
        shingler = _Shingler(size)

        def one(text: str | None) -> np.ndarray:
            h = shingler.hashes(text)
            key = np.frombuffer(hashlib.md5(h.tobytes()).digest(), np.int64)
            return np.concatenate((key, [len(h)], _least(h, permutations) if len(h) else np.zeros(permutations, np.int64)))

        return texts.map(one)

    made = rows.select(*keys, F.pandas_udf(run, "array<long>")(F.col(text)).alias("_all"))
    return made.select(*keys, F.concat_ws("/", F.element_at("_all", 1), F.element_at("_all", 2)).alias("set_key"), F.element_at("_all", 3).cast("int").alias("n"), F.slice("_all", 4, permutations).alias("signature"))


#: Classes of a bucket that are compared each with each; larger buckets are split by a further band, then compared with their least.
PAIRED = 500
#: The least classes of a large bucket that all others are compared with in a round.
PIVOTS = 64
#: Bands that follow a band, by which its large buckets are split: half of all, so that any two bands meet.
FURTHER = BANDS // 2


def _pairs(buckets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the classes (``k``, ``n``) of each ``bucket`` whose sizes allow the threshold."""
    pairs = buckets.alias("a").join(buckets.alias("b"), "bucket").where("a.k < b.k")
    return pairs.where(F.least("a.n", "b.n") / F.greatest("a.n", "b.n") >= threshold).select(F.col("a.k").alias("left"), F.col("b.k").alias("right"))


def candidate_pairs(classes: DataFrame, key: str, threshold: float = 0.8, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """``left``, ``right`` of classes that agree in a band, each pair once; and ``bucket``, ``k``, ``n`` of buckets too large for pairs.

    At a similarity of 0.8 a pair agrees in none of the bands with a probability of 5e-8. A bucket of more than PAIRED classes is
    split by the FURTHER bands that follow its own; a pair that agrees in large buckets only needs two bands, which it lacks
    with a probability of 1e-6. What stays large then agrees in eight minima, as the variants of one template do, and is
    compared with its least classes only.
    """
    spark = classes.sparkSession
    scratch = Scratch(spark, "bands")
    rows = PERMUTATIONS // bands
    values = F.array(*[F.xxhash64(F.slice("signature", b * rows + 1, rows)) for b in range(bands)])
    named = lambda some: some.select(F.col(key).alias("k"), "n", F.posexplode(values).alias("band", "value")).select("k", "n", "band", F.xxhash64("band", "value").alias("bucket"))
    sizes = named(classes).groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    shared = scratch.save("shared", named(classes).join(sizes, "bucket"))
    out = _pairs(shared.where(F.col("c") <= PAIRED).select("bucket", "k", "n"), threshold)
    hot = shared.where(F.col("c") > PAIRED).select("k", "n", "band", "bucket")
    if hot.isEmpty():
        return out.distinct(), hot.select("bucket", "k", "n")
    near = named(classes.join(hot.select(F.col("k").alias(key)).distinct(), key, "left_semi")).select("k", F.col("band").alias("other"), F.col("bucket").alias("second"))
    split = hot.join(near, "k").where(F.pmod(F.col("other") - F.col("band"), F.lit(bands)).between(1, FURTHER))
    split = scratch.save("split", split.select("k", "n", F.xxhash64("bucket", "second").alias("bucket")))
    marked = scratch.save("marked", split.join(split.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "bucket"))
    scratch.drop("split")
    out = out.unionByName(_pairs(marked.where(F.col("c") <= PAIRED).select("bucket", "k", "n"), threshold))
    return out.distinct(), marked.where(F.col("c") > PAIRED).select("bucket", "k", "n")


def jaccard(a: Column, b: Column) -> Column:
    """Common part of two sets given as arrays."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def near_duplicates(rows: DataFrame, key: str, text: str, threshold: float = 0.8, least: int = 30, size: int = 5) -> DataFrame:
    """``key``, ``class_key`` and ``kept`` of each row: greedy near-duplicate removal in the order of the keys.

    Rows with equal sets of shingles are one class, named by its least key, so copies, however many, cost one row in a
    bucket. Min-hashes only propose pairs of classes; the shingle sets of these are compared. A row goes if it is similar
    to an earlier row that stays; so of a chain in which only neighbours are alike, every other stays. Not all similar pairs
    are listed: in a large bucket rows are compared with those that stay, so a family of variants costs one comparison a row. Rows with fewer
    than ``least`` characters all stay. Decided in rounds: who has no undecided or kept earlier neighbour stays, then its
    later neighbours go. Keys must be unique; rows with a null key are left out.
    """
    scratch = Scratch(rows.sparkSession, "near")
    long = rows.where(F.col(key).isNotNull() & (F.length(stripped(F.coalesce(F.col(text), F.lit("")))) >= least))
    signed = scratch.save("signed", signatures(long, [key], text, size))
    first = signed.groupBy("set_key").agg(F.min(key).alias("class_key"))
    member = scratch.save("member", signed.join(first, "set_key").select(key, "class_key"))
    classes = signed.join(member.where(F.col(key) == F.col("class_key")).select(key), key, "left_semi")
    found, large = candidate_pairs(classes, key, threshold)
    pairs, large = scratch.save("pairs", found), scratch.save("large", large)
    scratch.drop("signed")
    asked = pairs.select(F.col("left").alias(key)).union(pairs.select("right")).union(large.select("k")).distinct()
    sets = scratch.save("sets", long.join(asked, key, "left_semi").select(F.col(key).alias("k"), shingle_hashes(F.col(text), size).alias("h")))

    def alike(some: DataFrame) -> DataFrame:
        full = some.join(sets.select(F.col("k").alias("left"), F.col("h").alias("lh")), "left").join(sets.select(F.col("k").alias("right"), F.col("h").alias("rh")), "right")
        return full.where(jaccard(F.col("lh"), F.col("rh")) >= threshold).select("left", "right")

    edges = scratch.save("edges", alike(pairs))
    scratch.drop("pairs")
    has_large = not large.isEmpty()
    open_ = scratch.save("open0", edges.select(F.col("left").alias("k")).union(edges.select(F.col("right"))).union(large.select("k")).distinct())
    gone: DataFrame | None = None
    turn = 0
    waiting: DataFrame | None = None
    while not open_.isEmpty():
        if has_large:
            # all in a large bucket are compared with its least undecided ones, which are ready to be decided; the others wait
            here = scratch.save(f"here{turn}", large.join(open_, "k"))
            pivots = here.withColumn("_at", F.row_number().over(Window.partitionBy("bucket").orderBy("k"))).where(F.col("_at") <= PIVOTS).select("bucket", F.col("k").alias("left"), F.col("n").alias("m"))
            pivots = scratch.save(f"pivots{turn}", pivots)
            waiting = scratch.save(f"waiting{turn}", here.join(pivots.select("bucket", F.col("left").alias("k")), ["bucket", "k"], "left_anti").select("k").distinct())
            some = here.join(pivots, "bucket").where((F.col("k") > F.col("left")) & (F.least("n", "m") / F.greatest("n", "m") >= threshold))
            fresh = alike(some.select("left", F.col("k").alias("right")).distinct())
            known = scratch.save(f"known{turn}", edges.unionByName(fresh))
        else:
            known = edges
        while True:
            turn += 1
            live = known.join(open_.select(F.col("k").alias("left")), "left", "left_semi").join(open_.select(F.col("k").alias("right")), "right", "left_semi")
            live = scratch.save(f"live{turn}", live)
            waits = live.select(F.col("right").alias("k"))
            stay = scratch.save(f"stay{turn}", open_.join((waits if waiting is None else waits.union(waiting)).distinct(), "k", "left_anti"))
            if stay.isEmpty():
                break
            drop = scratch.save(f"drop{turn}", live.join(stay.select(F.col("k").alias("left")), "left", "left_semi").select(F.col("right").alias("k")).distinct())
            open_ = scratch.save(f"open{turn}", open_.join(stay, "k", "left_anti").join(drop, "k", "left_anti"))
            gone = drop if gone is None else gone.union(drop)
            if not has_large and open_.isEmpty():
                break
    out = rows.where(F.col(key).isNotNull()).select(key).join(member, key, "left").withColumn("class_key", F.coalesce("class_key", key))
    if gone is None:
        return out.select(key, "class_key", (F.col(key) == F.col("class_key")).alias("kept"))
    out = out.join(gone.select(F.col("k").alias("class_key"), F.lit(True).alias("_gone")), "class_key", "left")
    return out.select(key, "class_key", ((F.col(key) == F.col("class_key")) & F.col("_gone").isNull()).alias("kept"))


def against_index(rows: DataFrame, key: str, text: str, index: DataFrame, threshold: float = 0.8, least: int = 20, size: int = 5) -> DataFrame:
    """For each row like an indexed one its ``key``, ``duplicate_of`` (the most similar, of equals the least) and ``similarity``.

    ``index`` is a table of ``signatures`` under the column ``key``, such as an earlier run has written; rows that aren't found
    are what it can be extended by. Similarity is the share of equal minima. Rows under ``least`` characters are in no pair.
    The bands of both are joined; of indexed rows with equal sets of shingles the least stands for all.
    """
    rows_a_band = PERMUTATIONS // BANDS
    bands = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.slice("signature", b * rows_a_band + 1, rows_a_band)).alias("bucket")) for b in range(BANDS)])).alias("x")
    asked = signatures(rows.where(F.length(stripped(F.coalesce(text, F.lit("")))) >= least), [key], text, size)
    own = asked.groupBy("set_key").agg(F.min(key).alias("_rep"), F.first("signature").alias("signature"))
    known = index.groupBy("set_key").agg(F.min(key).alias("other"), F.first("signature").alias("signature"))
    pairs = own.select("_rep", bands).join(known.select("other", bands), "x").select("_rep", "other").distinct()
    both = pairs.join(own.select("_rep", F.col("signature").alias("a")), "_rep").join(known.select("other", F.col("signature").alias("b")), "other")
    equal = F.size(F.filter(F.zip_with("a", "b", lambda a, b: a == b), lambda e: e))
    found = both.select("_rep", "other", (equal / PERMUTATIONS).alias("similarity")).where(F.col("similarity") >= threshold)
    best = found.groupBy("_rep").agg(F.min(F.struct(-F.col("similarity"), "other")).alias("b"))
    members = asked.select(key, "set_key").join(own.select("set_key", "_rep"), "set_key")
    return members.join(best, "_rep").select(key, F.col("b.other").alias("duplicate_of"), (-F.col("b.col1")).alias("similarity"))
