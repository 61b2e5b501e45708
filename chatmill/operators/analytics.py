"""Corpus statistics, one frame a section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.functions.text import content_words, onward, stripped, token_count, word_count
from chatmill.operators.taxonomy import AI, BACKEND, DEVOPS
from chatmill.plans.ranks import with_previous, with_running_sum
from chatmill.plans.scratch import Scratch

# Jargon of the community that is counted.
SLANG = """деплой деплоить задеплоил прод продакшн проде мерж смержить стек стека пыха пыхе жаба джава кубер кубере кубик шадсн курсор курсоре дипсик дипсика дипсике
коммит коммитить парсер парсить собес собесы джун джуна мидл сеньор тимлид лид апворк апворке хостинг хостинге вдс вдска докер докере селектел хетзнер хетцнере
микросервис бд база базы монолит оффер репа репозиторий пуллреквест пр хэндлер эндпоинт вебхук кликхаус кликхаусе редис редисе кафка кафке постгрес постгре прокси впн
шлюз эквайринг инвойс страйп пэйпал крипта биток эфир нода ноды фронт бэк бекенд бэкенд апишка либа костыль костыли баг фиксы багфикс хотфикс галера пет петпроект
стартап фаундер питч венчур ангел раунд бутстрап саас saas митап синк таска спринт бэклог""".split()
CODE_MARKS = ("```", "def ", "class ", "import ", "function ", "const ", "SELECT ", "{", "=>", "();")


def rank_percentiles(rows: DataFrame, value: str, shares: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99), by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``mean``, ``std`` (of a sample), ``least``, ``most`` and ``p25``... as the value at rank int(share * n).

    The ranks come from counts of distinct values, put in order by ranges.
    """
    by = list(by)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    # ranks by ranges, so that no key and no task has all different values
    ordered = with_running_sum(counts, [*[F.col(c) for c in by], F.col("v")], "c", "all")
    ordered = Scratch(rows.sparkSession, "percentiles").save("ordered", ordered)
    groups = ordered.groupBy(*by).agg(F.min(F.col("all") - F.col("c")).alias("before"), F.sum("c").alias("n"))
    ranked = (ordered.join(groups.withColumnsRenamed({c: f"_{c}" for c in by}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]) if by else ordered.crossJoin(F.broadcast(groups))).withColumn("upto", F.col("all") - F.col("before"))
    picks = [F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * s), F.col("n") - 1), F.col("v"))).alias(f"p{round(s * 100)}") for s in shares]
    mean = F.sum(F.col("v") * F.col("c")) / F.sum("c")
    squares = F.sum(F.col("v").cast("double") * F.col("v") * F.col("c"))
    n = F.sum("c")
    std = F.when(n > 1, F.sqrt(F.greatest((squares - n * mean * mean) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))))
    return ranked.groupBy(*by).agg(n.alias("n"), mean.alias("mean"), std.alias("std"), F.min("v").alias("least"), F.max("v").alias("most"), *picks)


def volume(rows: DataFrame) -> DataFrame:
    """One row: messages, authors, chats, words, tokens, days covered and messages a day."""
    words = word_count(F.col("text_clean"))
    days = F.greatest(F.floor((F.max("unixtime") - F.min("unixtime")) / 86400), F.lit(1))
    return rows.agg(
        F.count("*").alias("messages"), F.count_distinct("author_id_anon").alias("authors"), F.count_distinct("chat_id").alias("chats"), F.sum(words).alias("words"),
        F.sum(token_count(F.col("text_clean"))).alias("tokens"), F.sum(F.length(F.coalesce("text_clean", F.lit("")))).alias("characters"), days.cast("long").alias("days"), (F.count("*") / days).alias("messages_a_day"),
    )


def volume_distributions(rows: DataFrame) -> DataFrame:
    """``measure`` and statistics of characters, words and tokens of the messages, and of messages an author."""
    text = F.col("text_clean")
    measured = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("long").alias("v")) for n, c in (("characters", F.length(F.coalesce(text, F.lit("")))), ("words", word_count(text)), ("tokens", token_count(text)))])).alias("x")).select("x.*")
    authors = rows.groupBy(F.coalesce("author_anon", F.lit(""))).agg(F.count("*").alias("v")).select(F.lit("messages an author").alias("measure"), "v")
    return rank_percentiles(measured.unionByName(authors), "v", by=["measure"])


def activity(rows: DataFrame, unit: str) -> DataFrame:
    """``bucket`` and messages by hour, weekday (Monday 0), month or year, of times in UTC."""
    at = F.timestamp_seconds("unixtime")
    bucket = {"hour": F.hour(at), "weekday": F.weekday(at), "month": F.date_format(at, "yyyy-MM"), "year": F.year(at)}[unit]
    return rows.where("unixtime is not null").groupBy(bucket.cast("string").alias("bucket")).agg(F.count("*").alias("messages"), F.avg(F.length("text_clean")).alias("mean_length"))


def busiest(rows: DataFrame, unit: str) -> DataFrame:
    """The bucket with most messages, of equals the smallest."""
    return activity(rows, unit).groupBy().agg(F.min_by("bucket", F.struct(-F.col("messages"), F.length("bucket"), F.col("bucket"))).alias("bucket"), F.max("messages").alias("messages"))


def intervals(rows: DataFrame, most: int = 86400) -> DataFrame:
    """Statistics of the seconds between a message and the next of its chat, up to ``most``."""
    narrow = rows.where("unixtime is not null").select("chat_id", "msg_id", "unixtime")
    ordered = with_previous(narrow, [F.col("chat_id"), F.col("unixtime"), F.col("msg_id")], ["chat_id", "unixtime"])
    gap = F.when(F.col("prev_chat_id").eqNullSafe(F.col("chat_id")), F.col("unixtime") - F.col("prev_unixtime"))
    return rank_percentiles(ordered.withColumn("gap", gap).where(F.col("gap").between(0, most)), "gap")


def ngrams(rows: DataFrame, text: str, n: int, most: int) -> DataFrame:
    """``term`` and ``n`` of the most frequent runs of ``n`` content words; ties by term."""
    w = content_words(F.col(text))
    joined = w
    for k in range(2, n + 1):
        joined = F.zip_with(joined, onward(w, k), lambda a, b: F.concat_ws(" ", a, b))
    if n > 1:
        joined = F.slice(joined, 1, F.greatest(F.size(w) - (n - 1), F.lit(0)))
    return rows.select(F.explode(joined).alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(most)


def lexical_diversity(rows: DataFrame, text: str) -> DataFrame:
    """One row: content words, different ones, their entropy in bits, type-token ratio and its root form."""
    counts = rows.select(F.explode(content_words(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("c"))
    # -sum p log2 p = log2 N - sum c log2 c / N
    total = F.sum("c")
    return counts.agg(F.coalesce(total, F.lit(0)).alias("words"), F.count("*").alias("distinct_words"), (F.log2(total) - F.sum(F.col("c") * F.log2("c")) / total).alias("entropy"), (F.count("*") / total).alias("ttr"), (F.count("*") / F.sqrt(total)).alias("root_ttr"))


def slang_counts(rows: DataFrame, text: str, most: int = 35) -> DataFrame:
    found = rows.select(F.explode(F.array_intersect(F.array_distinct(content_words(F.col(text))), F.array(*[F.lit(s) for s in SLANG]))).alias("term"), content_words(F.col(text)).alias("all"))
    return found.select("term", F.size(F.filter("all", lambda w: w == F.col("term"))).alias("k")).groupBy("term").agg(F.sum("k").alias("n")).orderBy(F.desc("n"), "term").limit(most)


def distribution(rows: DataFrame, column: str) -> DataFrame:
    """Value, count and percentage; null is a value."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("value", "n", (F.col("n") * 100 / F.col("total")).alias("percentage"))


def top_tags(rows: DataFrame, most: int = 40) -> DataFrame:
    return rows.select(F.explode("tags").alias("tag")).where("tag is not null").groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag").limit(most)


def mood(rows: DataFrame, score: Column) -> DataFrame:
    return rows.select(score.alias("s")).agg(F.avg("s").alias("mean"), F.count_if(F.col("s") > 0).alias("positive"), F.count_if(F.col("s") < 0).alias("negative"), F.count_if(F.col("s") == 0).alias("neutral"))


def questions_and_code(rows: DataFrame, text: str) -> DataFrame:
    code = F.lit(False)
    for m in CODE_MARKS:
        code = code | F.contains(F.col(text), F.lit(m))
    return rows.agg(F.count("*").alias("messages"), F.count_if(F.contains(F.col(text), F.lit("?"))).alias("questions"), F.count_if(code).alias("with_code"))


def key_phrases(rows: DataFrame, author: str, text: str, authors: int = 25, least: int = 30, phrases: int = 5) -> DataFrame:
    """The words that set the most active authors apart: count / (count over all + 2) * ln(count + 1)."""
    busy = rows.groupBy(author).agg(F.count("*").alias("m")).where(F.col("m") >= least).orderBy(F.desc("m"), author).limit(authors)
    said = rows.select(author, F.explode(content_words(F.col(text))).alias("term"))
    overall = said.groupBy("term").agg(F.count("*").alias("overall"))
    # at most ``authors`` rows
    own = said.join(F.broadcast(busy.select(author)), author).groupBy(author, "term").agg(F.count("*").alias("n")).where("n >= 2")
    scored = own.join(overall, "term").withColumn("score", F.col("n") / (F.col("overall") + 2) * F.log(F.col("n") + 1))
    return scored.withColumn("place", F.row_number().over(Window.partitionBy(author).orderBy(F.desc("score"), "term"))).where(F.col("place") <= phrases).select(author, "place", "term", "n", "score")


def yearly_terms(rows: DataFrame, text: str, most: int = 8) -> DataFrame:
    """The most frequent content words of each year."""
    said = rows.where("unixtime is not null").select(F.year(F.timestamp_seconds("unixtime")).alias("year"), F.explode(content_words(F.col(text))).alias("term")).groupBy("year", "term").agg(F.count("*").alias("n"))
    return said.withColumn("place", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("n"), "term"))).where(F.col("place") <= most)


def yearly_technology(rows: DataFrame, text: str, most: int = 8, among: int = 40) -> DataFrame:
    """The technical words among the ``among`` most frequent content words of each year, and the year's messages."""
    technical = sorted({*SLANG, *AI, *BACKEND, *DEVOPS})
    found = yearly_terms(rows, text, among).where(F.col("term").isin(*technical)).drop("place")
    placed = found.withColumn("place", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("n"), "term"))).where(F.col("place") <= most)
    sizes = rows.where("unixtime is not null").groupBy(F.year(F.timestamp_seconds("unixtime")).alias("year")).agg(F.count("*").alias("messages"))
    return placed.join(sizes, "year")


def noise(rows: DataFrame) -> DataFrame:
    text = F.coalesce("text_clean", F.lit(""))
    return rows.agg(F.count("*").alias("messages"), F.count_if(F.length(stripped(text)) < 20).alias("short"), F.count_if(word_count(text) == 0).alias("wordless"), F.count_if(F.abs("sentiment_score") >= 2).alias("emotional"))


def quality_index(rows: DataFrame) -> DataFrame:
    """One row with the parts of the quality index (at most 100), its total and tier."""
    facts = rows.agg(F.count("*").alias("m"), F.count_distinct("author_id_anon").alias("a"), F.count_if(F.col("domain") != "general_tech_chat").alias("d"), F.count_if(F.col("is_question")).alias("q"))
    n = F.greatest(F.col("m"), F.lit(1))
    both = facts.crossJoin(F.broadcast(lexical_diversity(rows, "text_clean").select("entropy")))
    parts = both.select(
        _steps(F.col("m"), [(300000, 25), (100000, 18), (30000, 10)], 5).alias("volume_score"),
        _steps(F.col("a"), [(2000, 20), (500, 15), (100, 10)], 5).alias("author_score"),
        _steps(F.col("d") / n, [(0.35, 20), (0.20, 15)], 10).alias("technical_score"),
        _steps(F.col("q") / n, [(0.15, 15)], 8).alias("dialogue_score"),
        _steps(F.coalesce("entropy", F.lit(0.0)), [(10.0, 10), (7.0, 7)], 3).alias("lexical_score"),
        F.lit(10).alias("pii_score"),
    )
    total = sum((F.col(c) for c in parts.columns[1:]), F.col(parts.columns[0]))
    return parts.withColumn("total_score", F.least(total, F.lit(100))).withColumn("tier", F.when(F.col("total_score") >= 85, "A").when(F.col("total_score") >= 70, "B").otherwise("C"))


def _steps(x: Column, pairs, rest: int) -> Column:
    out = F.when(x >= pairs[0][0], pairs[0][1])
    for least, points in pairs[1:]:
        out = out.when(x >= least, points)
    return out.otherwise(rest)


def topics(rows: DataFrame, author: str, text: str, k: int = 8, words: int = 10, messages: int = 100, seed: int = 42) -> DataFrame:
    """``topic``, ``place``, ``term``, ``weight`` of a topic model over what all authors wrote.

    A document is an author of over 20 words; who has more than ``messages`` messages is cut into documents of about as
    many, by a hash of the message. Each pass draws as many documents as there are, with replacement, so that one is in
    none of the 15 passes with a probability of 3e-7.
    """
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    scratch = Scratch(rows.sparkSession, "topics")
    said = rows.select(F.coalesce(author, F.lit("")).alias("_author"), F.xxhash64("chat_id", "msg_id").alias("_id"), content_words(F.col(text)).alias("_words"))
    parts = said.groupBy("_author").agg(F.ceil(F.count("*") / messages).alias("_parts"), F.sum(F.size("_words")).alias("_n")).where("_n > 20").drop("_n")
    cut = said.join(parts, "_author").groupBy("_author", F.pmod("_id", "_parts").alias("_part"))
    docs = scratch.save("docs", cut.agg(F.flatten(F.collect_list("_words")).alias("words")))
    counted = CountVectorizer(inputCol="words", outputCol="features", minDF=2, maxDF=0.6, vocabSize=5000).fit(docs)
    features = scratch.save("features", counted.transform(docs).select("features"))
    scratch.drop("docs")
    model = LDA(k=k, maxIter=15, seed=seed, featuresCol="features", optimizer="online", subsamplingRate=1.0).fit(features)
    scratch.drop("features")
    described = model.describeTopics(words)
    # zipped on the driver's small vocabulary
    vocabulary = F.array(*[F.lit(v) for v in counted.vocabulary])
    return described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "x")).select("topic", "place", F.element_at(vocabulary, F.col("x.termIndices") + 1).alias("term"), F.col("x.termWeights").alias("weight"))
