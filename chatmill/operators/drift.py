"""How far two snapshots of a corpus are apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def level(value: Column, moderate: float, significant: float, falling: bool = False) -> Column:
    if falling:
        return F.when(value >= moderate, "stable").when(value >= significant, "moderate_drift").otherwise("significant_drift")
    return F.when(value < moderate, "stable").when(value < significant, "moderate_drift").otherwise("significant_drift")


def length_shift(reference: DataFrame, current: DataFrame, text: str, buckets: int = 10, least: float = 1e-6) -> DataFrame:
    """One row: population stability index of text lengths, in buckets between the reference's deciles."""
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    edges = reference.agg(F.array_sort(F.array_distinct(F.percentile(length, [k / buckets for k in range(1, buckets)]))).alias("edges"))
    def shares(rows: DataFrame, name: str) -> DataFrame:
        # lengths are counted before the edges are joined, so the single row of edges meets few rows
        counts = rows.groupBy(length.alias("l")).agg(F.count("*").alias("c"))
        placed = counts.crossJoin(F.broadcast(edges)).select(F.size(F.filter("edges", lambda e: e <= F.col("l"))).alias("bucket"), "c", F.size("edges").alias("last"))
        return placed.groupBy("bucket").agg(F.sum("c").alias(name))

    both = shares(reference, "r").join(shares(current, "k"), "bucket", "full_outer")
    totals = both.agg(F.sum("r").alias("rt"), F.sum("k").alias("kt"))
    p = both.crossJoin(F.broadcast(totals)).select(F.greatest(F.coalesce("r", F.lit(0)) / F.col("rt"), F.lit(least)).alias("p"), F.greatest(F.coalesce("k", F.lit(0)) / F.col("kt"), F.lit(least)).alias("q"))
    return p.agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi")).withColumn("verdict", level(F.col("psi"), 0.10, 0.25))


def label_shift(reference: DataFrame, current: DataFrame, label: str, least: float = 1e-10) -> DataFrame:
    """One row: Jensen-Shannon divergence of the labels in bits, and the label whose share moved most (in points)."""
    name = F.coalesce(F.col(label), F.lit("unknown")).alias("label")
    both = reference.groupBy(name).agg(F.count("*").alias("r")).join(current.groupBy(name).agg(F.count("*").alias("k")), "label", "full_outer").fillna(0, ["r", "k"])
    totals = both.agg(F.sum("r").alias("rt"), F.sum("k").alias("kt"))
    s = both.crossJoin(F.broadcast(totals)).select("label", (F.col("r") / F.col("rt")).alias("a"), (F.col("k") / F.col("kt")).alias("b"))
    p, q = F.col("a") + least, F.col("b") + least
    m = (p + q) / 2
    delta = (F.col("b") - F.col("a")) * 100
    return s.agg(F.sum(0.5 * p * F.log2(p / m) + 0.5 * q * F.log2(q / m)).alias("divergence"), F.max_by("label", F.struct(F.abs(delta), delta, F.col("label"))).alias("moved_label"), F.max_by(delta, F.struct(F.abs(delta), delta, F.col("label"))).alias("moved_points")).withColumn("verdict", level(F.col("divergence"), 0.05, 0.20))


def vocabulary_shift(reference: DataFrame, current: DataFrame, text: str, most: int = 500) -> DataFrame:
    """One row: overlap of the most frequent words of both sides (ties by word), new and dropped words."""
    word = F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"([a-zA-Zа-яё0-9]{3,})"), 1)).alias("word")
    top = lambda rows, mark: rows.select(word).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(most).select("word", F.lit(1).alias(mark))
    both = top(reference, "r").join(top(current, "k"), "word", "full_outer")
    out = both.agg(F.count_if(F.col("r").isNotNull() & F.col("k").isNotNull()).alias("shared"), F.count_if(F.col("r").isNull()).alias("new_words"), F.count_if(F.col("k").isNull()).alias("dropped_words"), F.count("*").alias("all"))
    jaccard = F.when(F.col("all") == 0, 1.0).otherwise(F.col("shared") / F.nullif(F.col("all"), F.lit(0)))
    return out.select(jaccard.alias("jaccard"), "shared", "new_words", "dropped_words").withColumn("verdict", level(F.col("jaccard"), 0.90, 0.75, falling=True))


def overall(*reports: DataFrame) -> DataFrame:
    """The worst of the verdicts."""
    rank = F.array_position(F.array(F.lit("stable"), F.lit("moderate_drift"), F.lit("significant_drift")), F.col("verdict"))
    all_ = reports[0].select("verdict")
    for r in reports[1:]:
        all_ = all_.unionByName(r.select("verdict"))
    return all_.agg(F.max_by("verdict", rank).alias("verdict"))
