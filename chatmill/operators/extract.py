"""Dialogues, preference pairs and knowledge chunks from threads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.functions.text import stripped, token_count, word_count
from chatmill.operators.taxonomy import DEFAULT_DOMAIN, keywords_contained

# Wordings by which a text gives itself away as written by a language model.
MODEL_MARKS = (
    r"(?iU)\b(?:как\s+)?(?:большая\s+)?языковая\s+модель\b",
    r"(?iU)\b(?:как\s+)?искусственный\s+интеллект\b",
    r"(?iU)\bя\s*[-—–]?\s*(?:языковая\s+модель|искусственный\s+интеллект|виртуальный\s+ассистент|бот|ии)\b",
    r"(?iU)\b(?:as\s+an?\s+ai|as\s+a\s+language\s+model|i\s+am\s+an?\s+ai|i'm\s+a\s+language\s+model)\b",
    r"(?iU)\bнас\s*\(модели\s+[a-zA-Z0-9_-]+\)\s*тренируют",
    r"(?iU)\bмои\s+разработчики\s+из\s+(?:openai|anthropic|google|yandex)\b",
    r"(?imU)\b(?:claude\s+[0-9.]+\s*(?:sonnet|opus|haiku)?|gemini\s+[0-9.]+\s*(?:pro|flash)?|chatgpt)\s*$",
)
# Reactions that say nothing; those of one word never get this far.
TRIVIAL = ("не знаю",)


def is_model_text(text: Column) -> Column:
    hit = F.lit(False)
    for p in MODEL_MARKS:
        hit = hit | F.coalesce(text.rlike(p), F.lit(False))
    return hit


def message_quality(text: Column) -> Column:
    """0 to 7.5, not rounded: length, keywords contained, sentence marks; low for trivial or machine-written texts."""
    low = F.lower(F.coalesce(text, F.lit("")))
    words = word_count(text)
    hits = keywords_contained(text)
    bare = F.regexp_replace(low, r"^[!.?,]+|[!.?,]+$", "")
    marks = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[.!?]"))
    score = F.lit(1.0) + F.least(F.lit(3.0), words / 15.0) + F.least(F.lit(3.0), hits * 0.6) + F.when(marks >= 2, 0.5).otherwise(0.0)
    return F.when(words < 2, 0.0).when(is_model_text(text), 0.1).when(bare.isin(*TRIVIAL), 0.2).otherwise(score)


def _ordered(name: str, *columns: str) -> Column:
    return F.array_sort(F.collect_list(F.struct("pos", *columns))).alias(name)


def primary_domain(rows: DataFrame) -> DataFrame:
    """thread_id and the most frequent domain of its messages; of equals the one seen first."""
    counted = rows.groupBy("thread_id", F.coalesce("domain", F.lit(DEFAULT_DOMAIN)).alias("domain")).agg(F.count("*").alias("n"), F.min("pos").alias("at"))
    return counted.groupBy("thread_id").agg(F.max_by("domain", F.struct("n", -F.col("at"))).alias("topic_domain"))


def thread_tags(rows: DataFrame, most: int) -> DataFrame:
    return rows.select("thread_id", F.explode("tags").alias("t")).where("t is not null").groupBy("thread_id").agg(F.slice(F.array_sort(F.collect_set("t")), 1, most).alias("topic_tags"))


def extract_dialogues(rows: DataFrame, most_turns: int = 32, least_quality: float = 2.0) -> DataFrame:
    """A dialogue for each thread that makes one, with its turns; not in any order.

    Takes thread_id, pos and the columns of cleaned messages. A thread needs two messages and two authors. Texts under
    three characters are passed over, messages of one author in a row are one turn (quality and time of the first), and
    at most ``most_turns`` turns count. Turns are user and assistant by turns; a last user turn goes, though it still
    counts in quality and tokens. Dialogues with a machine-written turn go, as do those of under four turns and
    under ``least_quality`` on average.
    """
    enough = rows.groupBy("thread_id").agg(F.count("*").alias("n"), F.min(F.coalesce("author_id_anon", F.lit(""))).alias("a"), F.max(F.coalesce("author_id_anon", F.lit(""))).alias("b"), F.min_by("chat_name", "pos").alias("chat_name")).where("n >= 2 and a <> b").select("thread_id", "chat_name")
    said = rows.where(F.length(stripped(F.coalesce("text_clean", F.lit("")))) >= 3)
    along = Window.partitionBy("thread_id").orderBy("pos")
    turn = F.sum(F.when(F.lag("author_id_anon").over(along).eqNullSafe(F.col("author_id_anon")) & F.lag("pos").over(along).isNotNull(), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    merged = said.withColumn("turn", turn).where(F.col("turn") <= most_turns).groupBy("thread_id", "turn").agg(_ordered("texts", "text_clean"), F.min_by("author_anon", "pos").alias("author"), F.min_by("timestamp", "pos").alias("timestamp"), F.min_by("text_clean", "pos").alias("opening"))
    content = F.array_join(F.transform("texts", lambda x: x["text_clean"]), "\n")
    turns = merged.select("thread_id", "turn", "author", "timestamp", content.alias("content"), message_quality(F.col("opening")).alias("quality"))
    per = turns.withColumns({"tokens": token_count(F.col("content")), "machine": is_model_text(F.col("content")), "role": F.when(F.col("turn") % 2 == 1, "user").otherwise("assistant")})
    whole = per.groupBy("thread_id").agg(F.max("turn").alias("turns"), F.sum("quality").alias("quality"), F.sum("tokens").alias("total_tokens"), F.array_sort(F.collect_list(F.struct("turn", "author", "content", "role", "timestamp", "machine"))).alias("all")).where("turns >= 2")
    kept = F.filter("all", lambda x: x["turn"] <= F.col("turn_count"))
    whole = whole.withColumn("turn_count", (F.col("turns") - F.col("turns") % 2).cast("long")).withColumn("kept", kept).withColumn("quality_score", F.col("quality") / F.col("turn_count"))
    whole = whole.where(~F.exists("kept", lambda x: x["machine"]) & ((F.col("quality_score") >= least_quality) | (F.col("turn_count") >= 4)))
    messages = F.transform("kept", lambda x: F.struct(x["author"].alias("author"), x["content"].alias("content"), x["role"].alias("role"), x["timestamp"].alias("timestamp")))
    return (
        whole.join(enough, "thread_id")
        .join(primary_domain(rows), "thread_id")
        .join(thread_tags(rows, 8), "thread_id", "left")
        .select("thread_id", "chat_name", "topic_domain", F.coalesce("topic_tags", F.array().cast("array<string>")).alias("topic_tags"), messages.alias("messages"), "quality_score", "turn_count", "total_tokens")
    )


def extract_preferences(rows: DataFrame, least_words: int = 3, margin: float = 1.5, floor: float = 3.0) -> DataFrame:
    """A pair for each thread whose first message got a clearly better and a clearly worse reply of others.

    Of equally good replies the earliest is chosen, of equally bad ones the latest is rejected.
    """
    root = rows.groupBy("thread_id").agg(F.count("*").alias("n"), F.min_by(F.struct("text_clean", "author_id_anon", "domain"), "pos").alias("root"), F.min("pos").alias("first")).where("n >= 3")
    root = root.where(word_count(F.col("root.text_clean")) >= least_words)
    others = rows.join(root, "thread_id").where((F.col("pos") > F.col("first")) & ~F.col("author_id_anon").eqNullSafe(F.col("root.author_id_anon")) & (F.length(stripped(F.col("text_clean"))) > 3))
    scored = others.select("thread_id", "root", "pos", F.col("text_clean").alias("reply"), message_quality(F.col("text_clean")).alias("score"))
    best = scored.groupBy("thread_id").agg(F.first("root").alias("root"), F.count("*").alias("n"), F.max(F.struct("score", -F.col("pos"), "reply")).alias("best"), F.min(F.struct("score", -F.col("pos"), "reply")).alias("worst"))
    good = best.where((F.col("n") >= 2) & (F.col("best.score") - F.col("worst.score") >= margin - 1e-9) & (F.col("best.score") >= floor - 1e-9) & ~is_model_text(F.col("best.reply")))
    return good.select("thread_id", F.col("root.text_clean").alias("prompt"), F.col("best.reply").alias("chosen"), F.col("worst.reply").alias("rejected"), F.col("root.domain").alias("domain"), F.col("best.score").alias("chosen_quality"), F.col("worst.score").alias("rejected_quality"))


def extract_chunks(rows: DataFrame, least_tokens: int = 15) -> DataFrame:
    """A knowledge chunk for each thread of at least ``least_tokens`` tokens."""
    whole = rows.groupBy("thread_id").agg(
        F.min_by("chat_name", "pos").alias("chat_name"), F.min_by("text_clean", "pos").alias("first"), F.min_by("timestamp", "pos").alias("since"), F.max_by("timestamp", "pos").alias("until"),
        F.count_distinct("author_anon").alias("participants_count"), F.count("*").alias("message_count"), _ordered("all", "author_anon", "text_clean"),
    )
    lines = F.transform(F.filter("all", lambda x: F.length(stripped(F.coalesce(x["text_clean"], F.lit("")))) > 1), lambda x: F.concat(F.lit("["), F.coalesce(x["author_anon"], F.lit("")), F.lit("]: "), x["text_clean"]))
    whole = whole.withColumn("content", F.array_join(lines, "\n")).withColumn("token_count", token_count(F.col("content"))).where(F.col("token_count") >= least_tokens)
    flat = F.replace(F.coalesce("first", F.lit("")), F.lit("\n"), F.lit(" "))
    title = F.when(F.length(flat) > 90, F.concat(F.left(flat, F.lit(90)), F.lit("..."))).when(flat == "", F.concat(F.lit("Technical discussion in "), F.col("chat_name"))).otherwise(flat)
    a, b = F.left("since", F.lit(10)), F.left("until", F.lit(10))
    dates = F.when(a.eqNullSafe(b), a).otherwise(F.concat(a, F.lit(" — "), b))
    return (
        whole.join(primary_domain(rows), "thread_id")
        .join(thread_tags(rows, 6), "thread_id", "left")
        .select(F.format_string("rag_kb_%06d", "thread_id").alias("chunk_id"), "thread_id", "chat_name", title.alias("title"), "topic_domain", F.coalesce("topic_tags", F.array().cast("array<string>")).alias("topic_tags"), "content", dates.alias("date_range"), "participants_count", "message_count", "token_count")
    )
