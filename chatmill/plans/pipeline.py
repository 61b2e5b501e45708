"""The whole way from chat exports to published tables, reports and checks."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.functions import text as T
from chatmill.operators import analytics, audit, dedup, drift, extract, network, pseudonyms, quality, scrub, taxonomy, threads
from chatmill.plans.scratch import Scratch
from chatmill.sources import contract, exports

ORDER = ["unixtime", "msg_id", "chat_id"]


class StageError(Exception):
    """A stage of the pipeline failed; the cause is attached."""


def clean(messages: DataFrame, communities: Sequence[str] = ()) -> DataFrame:
    """Normalized to cleaned messages; service and blank messages go.

    In this order: redaction with pseudonyms in forward headers, numbered mentions, community names, pseudonyms of authors, their
    names in all cases wherever texts hold them, counts.
    """
    rules = [r for r in scrub.RULES if r.category != "user_mentions"]
    own = messages.where(~F.coalesce("is_service", F.lit(False)) & (T.stripped(F.coalesce("text_raw", F.lit(""))) != ""))
    scratch = Scratch(messages.sparkSession, "names")
    known = scratch.save("known", pseudonyms.pseudonyms(own, "author_id_raw", "author_raw", ORDER))
    done = scratch.save("scrubbed", scrub.scrub_forwards(own, "text_raw", known, ORDER, rules, counts=False))
    done = scrub.number_mentions(done, "text_scrubbed", ORDER)
    if communities:
        done = done.withColumn("text_scrubbed", scrub.scrubbed(F.col("text_scrubbed"), [scrub.community_rule(communities)]))
    named = pseudonyms.anonymize_authors(done, "author_id_raw", "author_raw", ORDER, known)
    names = scratch.save("names", pseudonyms.all_names(messages, "author_raw"))
    masked = pseudonyms.mask_words(named, "text_scrubbed", names, any_case=True)
    text = scrub.tidied(F.col("text_masked"))
    return masked.withColumn("text_clean", text).select(
        "msg_id", "chat_id", "chat_name", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "unixtime", "author_anon", "author_id_anon", "text_clean", F.col("reply_to_id").cast("double").alias("reply_to_id"),
        T.is_question(F.col("text_clean")).alias("is_question"), T.token_count(F.col("text_clean")).alias("token_count_approx"),
    )


#: Name, text, and what the text must hold once it is cleaned.
RED_TEAM = (
    ("given name in the dative", "Отдай ключи от стенда Кириллу до обеда.", "[PERSON_REDACTED]"),
    ("given name in the instrumental", "Созвонился с Тимофеем, он против миграции.", "[PERSON_REDACTED]"),
    ("given name in the genitive", "Забери у Марины доступы.", "[PERSON_REDACTED]"),
    ("two names", "Сообщи Наталье и Григорию про релиз.", "[PERSON_REDACTED] и [PERSON_REDACTED]"),
    ("surname in the instrumental", "Тикет закрыт Зотовым.", "[PERSON_REDACTED]"),
    ("phone with spaces", "Набери +7 ( 9 2 6 ) 0 0 0 - 1 1 - 2 2 после шести", "[PHONE_REDACTED]"),
    ("phone with hyphens", "Запасной 8-926-000-11-22", "[PHONE_REDACTED]"),
    ("database address", "DSN=postgres://root:qwerty@10.20.30.40:5432/main", "[DATABASE_URL_REDACTED]"),
    ("key in code", "key = 'sk-proj-0123456789abcdef0123456789abcdef'", "[API_KEY_REDACTED]"),
    ("token in a comment", "# ghp_abcdefghijklmnopqrstuvwxyz0123456789", "[API_KEY_REDACTED]"),
    ("bot token", "TOKEN=987654321:ZYXwvuTSRqponMLKjihGFEdcba7654321zy", "[BOT_TOKEN_REDACTED]"),
    ("wallet", "перевод на 0x00112233445566778899aabbccddeeff00112233", "[CRYPTO_WALLET_ETH]"),
    ("forward header", "Forwarded from Наталья Реброва: читали уже?", "Forwarded from Developer_"),
    ("mention", "спроси у @senior_helper в личке", "@user_1"),
)
_RED_AUTHORS = ("Кирилл Зотов", "Тимофей Лапин", "Марина Реброва", "Наталья Зотова", "Григорий Лапин")


def red_team(spark: SparkSession) -> DataFrame:
    """``test_name``, ``expected`` and ``passed`` of texts made to slip through redaction, cleaned like any message."""
    kind = "chat_id long, msg_id long, chat_name string, timestamp timestamp, unixtime long, author_raw string, author_id_raw string, text_raw string, reply_to_id long, is_service boolean"
    row = lambda k, author, text: (1, k, "red team", None, k, author, f"id{author}", text, None, False)
    rows = [row(k, "tester", text) for k, (_, text, _) in enumerate(RED_TEAM)] + [row(100 + k, a, "привет всем") for k, a in enumerate(_RED_AUTHORS)]
    wanted = spark.createDataFrame([(k, n, e) for k, (n, _, e) in enumerate(RED_TEAM)], "msg_id long, test_name string, expected string")
    cleaned = clean(spark.createDataFrame(rows, kind)).select("msg_id", "text_clean")
    return wanted.join(cleaned, "msg_id", "left").select("test_name", "expected", F.coalesce(F.contains(F.col("text_clean"), F.col("expected")), F.lit(False)).alias("passed"))


def red_team_verdict(tests: DataFrame, leaks: int) -> str:
    """PASSED if at most one test fails and nothing leaked in production, else LEAKS_DETECTED."""
    failed = tests.agg(F.count_if(~F.col("passed")).alias("n")).first().n
    return "PASSED" if failed <= 1 and leaks == 0 else "LEAKS_DETECTED"


def without_duplicates(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Exact copies and near duplicates go; the first in the order of all messages stays. ``path``: where the rows lie, if they do."""
    from chatmill.plans.ranks import with_position

    exact = dedup.exact_duplicates_in_table(rows.sparkSession, path, "text_clean", ORDER) if path else dedup.exact_duplicates(rows, "text_clean", ORDER)
    placed = Scratch(rows.sparkSession, "placed").save("placed", with_position(exact, [F.col(c) for c in ORDER], "_place"))
    kept = dedup.near_duplicates(placed, "_place", "text_clean").where("kept").select("_place")
    return placed.join(kept, "_place", "left_semi").drop("_place")


def tag(rows: DataFrame) -> DataFrame:
    found = taxonomy.tagged(rows, "text_clean")
    return found.withColumnsRenamed({"domain_found": "domain", "tags_found": "tags", "sentiment_found": "sentiment_score"}).drop("domain_score", "domain_confidence")


def thread(rows: DataFrame) -> DataFrame:
    return rows.join(threads.build_threads(rows).select("chat_id", "msg_id", "thread_id", "pos"), ["chat_id", "msg_id"], "left")


def run(spark: SparkSession, sources: Sequence[str], out: str, communities: Sequence[str] = ()) -> dict[str, int]:
    """Reads exports and writes the published tables and lines below ``out``; returns the counts of the stages."""
    scratch = Scratch(spark, "pipeline")
    stage = "ingestion"
    try:
        raw = scratch.save("raw", exports.read_exports(spark, sources))
        stage = "redaction"
        cleaned = scratch.save("cleaned", clean(raw, communities))
        stage = "deduplication"
        unique = scratch.save("unique", without_duplicates(cleaned, scratch.path("cleaned")))
        stage = "tagging and threads"
        full = scratch.save("full", thread(tag(unique)))
        stage = "extraction"
        dialogues = scratch.save("dialogues", extract.extract_dialogues(full))
        chunks, pairs = scratch.save("chunks", extract.extract_chunks(full)), scratch.save("pairs", extract.extract_preferences(full))
        stage = "export"
        for name, rows in (("full_clean_messages", full), ("sft_dialogues", dialogues), ("rag_knowledge_base", chunks)):
            contract.write_artifact(rows, name, f"{out}/{name}.parquet")
        for name, lines in (("sft_sharegpt_format", contract.sharegpt(dialogues)), ("sft_alpaca_format", contract.alpaca(dialogues)), ("sft_openai_messages", contract.chatml(dialogues)), ("rag_chunks_kb", contract.plain_lines(chunks)), ("dpo_preference_pairs", contract.plain_lines(pairs))):
            contract.write_lines(lines, f"{out}/{name}.jsonl")
        contract.write_contract_manifest(f"{out}/schema_contract.json")
        for name, rows in (("sft", dialogues), ("rag", chunks), ("dpo", pairs)):
            save_report(preview(rows, "thread_id"), f"{out}/samples/{name}_sample_preview.json")
        missing = exports.missing_sources(spark, sources)
        if missing:
            save_report(missing, f"{out}/missing_sources.json")
        return {n: f.count() for n, f in (("raw", raw), ("cleaned", cleaned), ("unique", unique), ("dialogues", dialogues), ("chunks", chunks), ("pairs", pairs))}
    except exports.ExportError:
        raise
    except Exception as cause:
        raise StageError(f"{stage} failed: {cause}") from cause


def preview(rows: DataFrame, order: str, most: int = 15) -> list[dict]:
    """The first rows in an order, for looking at: a preview is a limit by nature."""
    return [r.asDict(recursive=True) for r in exports.head(rows, [order], most).collect()]


def analyse(rows: DataFrame) -> dict[str, list[dict]]:
    """The sections of the analytics report, each a small list of rows."""
    edge = Scratch(rows.sparkSession, "analysis").save("edges", network.edges(network.interactions(rows)))
    sections = {
        "volume": analytics.volume(rows),
        **{f"by_{u}": analytics.activity(rows, u).orderBy("bucket") for u in ("hour", "weekday", "month", "year")},
        "distributions": analytics.volume_distributions(rows),
        "busiest": analytics.busiest(rows, "hour"),
        "intervals": analytics.intervals(rows),
        **{f"{n}grams": analytics.ngrams(rows, "text_clean", n, most) for n, most in ((1, 50), (2, 30), (3, 20), (4, 15))},
        "lexical": analytics.lexical_diversity(rows, "text_clean"),
        "slang": analytics.slang_counts(rows, "text_clean"),
        "domains": analytics.distribution(rows, "domain"),
        "tags": analytics.top_tags(rows),
        "mood": analytics.mood(rows, F.col("sentiment_score")),
        "questions": analytics.questions_and_code(rows, "text_clean"),
        "authors": analytics.key_phrases(rows, "author_anon", "text_clean"),
        "years": analytics.yearly_terms(rows, "text_clean"),
        "technology": analytics.yearly_technology(rows, "text_clean"),
        "noise": analytics.noise(rows),
        "quality": analytics.quality_index(rows),
        "network": network.graph_measures(edge),
        "influencers": network.top_degrees(edge),
        "pairs": network.strong_pairs(edge),
    }
    return {name: [r.asDict(recursive=True) for r in frame.collect()] for name, frame in sections.items()}


def compare(reference: DataFrame, current: DataFrame) -> dict:
    parts = {"length": drift.length_shift(reference, current, "text_clean"), "domains": drift.label_shift(reference, current, "domain"), "vocabulary": drift.vocabulary_shift(reference, current, "text_clean")}
    out = {n: f.first().asDict() for n, f in parts.items()}
    order = ["stable", "moderate_drift", "significant_drift"]
    return out | {"overall_verdict": max((v["verdict"] for v in out.values()), key=order.index)}


def audit_report(rows: DataFrame, size: int = 100_000) -> dict:
    found = [r.asDict() for r in audit.run_audit(rows, "text_clean", "chat_name", F.concat_ws("/", "chat_id", "msg_id"), size).collect()]
    total = next((r for r in found if r["category"] == "total"), None)
    strata = [r.asDict() for r in audit.audit_strata(rows, "text_clean", "chat_name", F.concat_ws("/", "chat_id", "msg_id"), size).collect()]
    return {"verdict": total["verdict"] if total else "FAILED", "categories": found, "per_stratum": strata}


def validate(spark: SparkSession, out: str) -> dict:
    """Contracts of the published tables below ``out`` and the dialogue monitor."""
    found = {}
    for name in contract.SCHEMAS:
        verdict, wrong = contract.verify_artifact(spark, f"{out}/{name}.parquet", name)
        found[name] = {"verdict": verdict, "differences": wrong}
    return {"artifacts": found, "overall_passed": all(v["verdict"] == "VALID" for v in found.values()), "fingerprint": contract.fingerprint()}


def save_report(report: dict | list, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, indent=2, default=str)
