"""Keyword search over chunks with a relational TF-IDF ranking."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import onward
from chatmill.plans.scratch import Scratch

TERM = r"([\p{L}\p{N}_]{2,})"
MOST_FEATURES = 20_000
MOST_CANDIDATES = 5_000


def keywords(query: str, most: int = 10) -> list[str]:
    """The first words of three characters and more, in lower case, repeats kept."""
    return re.findall(r"[a-zA-Zа-яА-ЯёЁ0-9]{3,}", query.lower())[:most]


def keyword_score(text: Column, words: list[str]) -> Column:
    """1.5 for each keyword the text contains."""
    low = F.lower(F.coalesce(text, F.lit("")))
    score = F.lit(0.0)
    for w in words:
        score = score + F.when(F.contains(low, F.lit(w)), 1.5).otherwise(0.0)
    return score


def _terms(text: Column) -> Column:
    w = F.regexp_extract_all(F.lower(text), F.lit(TERM), 1)
    pairs = F.slice(F.zip_with(w, onward(w, 2), lambda a, b: F.concat_ws(" ", a, b)), 1, F.greatest(F.size(w) - 1, F.lit(0)))
    return F.concat(w, pairs)


def search(chunks: DataFrame, query: str, key: str, text: str, top: int = 5, mode: str = "hybrid", domain: str | None = None, domain_column: str = "topic_domain") -> DataFrame:
    """``key``, ``score`` and ``lexical`` of the best chunks; ties by key.

    The domain restricts only if it leaves something. Chunks with no keyword are out; of more than MOST_CANDIDATES,
    those with the best keyword score are ranked, ties by key: ranking a bounded candidate list is the feature. Words and
    pairs of words are weighted by (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), of candidates and query together, over
    the most frequent MOST_FEATURES; the cosine times 10 is the score. ``hybrid`` mixes in the keyword score by 0.35,
    ``lexical`` is that alone, as is any search of fewer than two candidates.
    """
    words = keywords(query)
    pool = chunks
    if domain is not None:
        own = chunks.where(F.col(domain_column) == domain)
        pool = own if not own.isEmpty() else chunks
    if not words:
        return pool.select(key, F.lit(0.0).alias("score"), F.lit(0.0).alias("lexical")).limit(0)
    hit = F.lower(text).rlike("|".join(f"\\Q{w}\\E" for w in dict.fromkeys(words)))
    found = pool.where(hit).select(F.col(key).alias("k"), F.col(text).alias("t"), keyword_score(F.col(text), words).alias("lexical")).orderBy(F.desc("lexical"), "k").limit(MOST_CANDIDATES)
    found = Scratch(chunks.sparkSession, "search").save("found", found)
    many = found.count()
    if mode == "lexical" or many < 2:
        return found.select(F.col("k").alias(key), F.col("lexical").alias("score"), "lexical").orderBy(F.desc("score"), key).limit(top)
    spark = chunks.sparkSession
    asked = spark.createDataFrame([(query,)], "t string").select(F.explode(_terms(F.col("t"))).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))
    said = found.select("k", F.explode(_terms(F.col("t"))).alias("term")).groupBy("k", "term").agg(F.count("*").alias("tf"))
    both = said.unionByName(asked.select(F.lit(None).cast(dict(said.dtypes)["k"]).alias("k"), "term", "tf"))
    # terms are used four times
    both = Scratch(spark, "terms").save("terms", both)
    n = many + 1
    stats = both.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).orderBy(F.desc("total"), "term").limit(MOST_FEATURES)
    weighted = both.join(F.broadcast(stats), "term").withColumn("w", (F.lit(1.0) + F.log("tf")) * (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1))
    norms = weighted.groupBy("k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    mine = weighted.where("k is null").select("term", F.col("w").alias("q"))
    length = norms.where("k is null").select(F.col("norm").alias("qnorm"))
    dots = weighted.where("k is not null").join(F.broadcast(mine), "term").groupBy("k").agg(F.sum(F.col("w") * F.col("q")).alias("dot"))
    scored = found.select("k", "lexical").join(dots, "k", "left").join(norms, "k", "left").crossJoin(F.broadcast(length))
    cosine = F.coalesce(F.col("dot") / F.nullif(F.col("norm") * F.col("qnorm"), F.lit(0.0)), F.lit(0.0))
    scored = scored.withColumn("cosine", cosine)
    best = found.agg(F.max("lexical").alias("best"))
    if mode == "hybrid":
        scored = scored.crossJoin(F.broadcast(best)).withColumn("score", (F.col("cosine") * 0.65 + F.col("lexical") / F.col("best") * 0.35) * 10)
    else:
        scored = scored.withColumn("score", F.col("cosine") * 10)
    return scored.where("score > 0").select(F.col("k").alias(key), "score", "lexical").orderBy(F.desc("score"), key).limit(top)


def keyword_recall(hits: DataFrame, text: str, expected: list[str]) -> DataFrame:
    """Percentage of the expected terms that occur in the found contexts."""
    said = hits.agg(F.array_join(F.collect_list(F.lower(text)), " ").alias("t"))
    found = sum((F.contains(F.col("t"), F.lit(e.lower())).cast("int") for e in expected), F.lit(0))
    return said.select((found * 100.0 / max(1, len(expected))).alias("recall_percentage"))


def prompt(hits: DataFrame, title: str, text: str, question: str) -> DataFrame:
    """One row with the contexts joined into a prompt; the hits are a top-k list."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col(title).alias("title"), F.col(text).alias("text")))), lambda x: F.concat(F.lit("### "), x["title"], F.lit("\n"), x["text"]))
    return hits.agg(F.concat(F.array_join(parts, "\n\n"), F.lit("\n\n? " + question)).alias("prompt"))
