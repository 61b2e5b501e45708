"""Published schemas, their version and fingerprint, and the sinks that write them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

from chatmill.functions.text import onward, stripped

VERSION = "1.0.0"
_STRINGS = ArrayType(StringType())
_TURNS = ArrayType(StructType([StructField(n, StringType()) for n in ("author", "content", "role", "timestamp")]))


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


_L, _T, _D = LongType(), StringType(), DoubleType()
# Columns of the published tables.
SCHEMAS = {
    "full_clean_messages": _schema(msg_id=_L, chat_id=_L, chat_name=_T, timestamp=_T, unixtime=_L, author_anon=_T, author_id_anon=_T, text_clean=_T, reply_to_id=_D, domain=_T, tags=_STRINGS, sentiment_score=_L, token_count_approx=_L, is_question=BooleanType(), thread_id=_L),
    "sft_dialogues": _schema(thread_id=_L, chat_name=_T, topic_domain=_T, topic_tags=_STRINGS, messages=_TURNS, quality_score=_D, turn_count=_L, total_tokens=_L),
    "rag_knowledge_base": _schema(chunk_id=_T, thread_id=_L, chat_name=_T, title=_T, topic_domain=_T, topic_tags=_STRINGS, content=_T, date_range=_T, participants_count=_L, message_count=_L, token_count=_L),
}


def fingerprint() -> str:
    """SHA-256 of version and schemas in canonical JSON."""
    content = {"version": VERSION, "artifacts": {n: [[f.name, f.dataType.simpleString()] for f in s.fields] for n, s in sorted(SCHEMAS.items())}}
    return hashlib.sha256(json.dumps(content, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


# The message that opens each conversation of an export for chat models.
SYSTEM_MESSAGE = (
    "Ты — опытный русскоязычный IT-консультант, Senior разработчик и архитектор. "
    "Отвечай на технические вопросы точно, структурированно, опираясь на реальные практики разработки, "
    "DevOps, архитектуры и IT-бизнеса."
)
#: Keys that the lines of each export have.
LINES = {"sft_sharegpt_format": ("id", "chat", "domain", "tags", "quality_score", "conversations"), "sft_alpaca_format": ("instruction", "input", "output", "domain", "tags", "quality_score"), "sft_openai_messages": ("id", "domain", "tags", "quality", "messages")}


def contract_manifest() -> dict:
    """Version, fingerprint, columns of the tables and keys of the lines."""
    return {
        "dataset_schema_version": VERSION,
        "schema_fingerprint": fingerprint(),
        "artifacts": {n: {"columns": [{"name": f.name, "type": f.dataType.simpleString()} for f in s.fields]} for n, s in sorted(SCHEMAS.items())},
        "jsonl": {n: list(k) for n, k in sorted(LINES.items())},
    }


def write_contract_manifest(path: str) -> str:
    """Writes the manifest as JSON; returns the path."""
    import os

    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(contract_manifest(), f, ensure_ascii=False, indent=2)
    return path


def stamped(rows: DataFrame) -> DataFrame:
    """``rows`` with version and fingerprint in the metadata of the first column, which Parquet files keep."""
    first = rows.columns[0]
    mark = {"dataset_schema_version": VERSION, "schema_fingerprint": fingerprint()}
    return rows.select(F.col(first).alias(first, metadata=mark), *rows.columns[1:])


def verify_artifact(spark: SparkSession, path: str, artifact: str, allow_unstamped: bool = False) -> tuple[str, list[str]]:
    """VALID, EMPTY, INVALID or CORRUPT, and the problems: columns, types, and version and fingerprint in the files.

    ``allow_unstamped`` accepts a table without these two, never one with others.
    """
    from chatmill.operators.quality import check_contract

    try:
        rows = spark.read.parquet(path)
        some = rows.limit(1).count()
    except Exception as cause:
        return "CORRUPT", [str(cause)[:200]]
    verdict, wrong = check_contract(rows.schema, SCHEMAS[artifact], some)
    mark = rows.schema[0].metadata if rows.schema else {}
    found = mark.get("dataset_schema_version"), mark.get("schema_fingerprint")
    if verdict != "EMPTY" and not (allow_unstamped and found == (None, None)):
        if found[0] != VERSION:
            wrong = [*wrong, f"schema version is {found[0]!r}, wanted {VERSION!r}"]
        if found[1] != fingerprint():
            wrong = [*wrong, "schema fingerprint is another"]
        verdict = "INVALID" if wrong else verdict
    return verdict, wrong


def align(rows: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``: unknown ones go, missing ones are null. ``strict`` raises on either."""
    extra = [c for c in rows.columns if c not in schema.names]
    missing = [c for c in schema.names if c not in rows.columns]
    if strict and (extra or missing):
        raise ValueError(f"extra columns {extra}, missing columns {missing}")
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_artifact(rows: DataFrame, artifact: str, path: str, rows_a_file: int = 0) -> int:
    """Writes a published table and returns its rows; messages without text are left out.

    The committer makes the files appear together; rows are counted as they are written.
    """
    seen = Observation()
    if artifact == "full_clean_messages":
        rows = rows.where(stripped(F.coalesce("text_clean", F.lit(""))) != "")
    counted = stamped(align(rows, SCHEMAS[artifact])).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite").option("compression", "zstd")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    writer.parquet(path)
    return seen.get["rows"]


def write_records(rows: DataFrame, path: str) -> None:
    """Writes rows as they are."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("overwrite").text(path)


def _json(*columns) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("line")


def sharegpt(dialogues: DataFrame) -> DataFrame:
    turns = F.transform("messages", lambda m: F.struct(F.when(m["role"] == "user", "human").otherwise("gpt").alias("from"), m["content"].alias("value")))
    return dialogues.select("thread_id", _json(F.concat(F.lit("dialogue_"), F.col("thread_id")).alias("id"), F.col("chat_name").alias("chat"), F.col("topic_domain").alias("domain"), F.col("topic_tags").alias("tags"), "quality_score", turns.alias("conversations")))


def instruction_pairs(dialogues: DataFrame) -> DataFrame:
    """A row for each user turn that an assistant turn follows: thread_id, pair_no, instruction, input, output."""
    after = onward("messages", 2)
    pairs = F.zip_with("messages", after, lambda a, b: F.struct(a["role"].alias("r"), b["role"].alias("s"), a["content"].alias("instruction"), b["content"].alias("output")))
    rows = dialogues.select("thread_id", "topic_domain", "topic_tags", "quality_score", F.posexplode(pairs).alias("pair_no", "p")).where("p.r = 'user' and p.s = 'assistant'")
    return rows.select("thread_id", F.col("pair_no").cast("long").alias("pair_no"), "p.instruction", F.lit("").alias("input"), "p.output", F.col("topic_domain").alias("domain"), F.col("topic_tags").alias("tags"), "quality_score")


def alpaca(dialogues: DataFrame) -> DataFrame:
    return instruction_pairs(dialogues).select("thread_id", _json("instruction", "input", "output", "domain", "tags", "quality_score"))


def chatml(dialogues: DataFrame, system: str = SYSTEM_MESSAGE) -> DataFrame:
    opening = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    turns = F.concat(opening, F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))
    return dialogues.select("thread_id", _json(F.concat(F.lit("chat_"), F.col("thread_id")).alias("id"), F.col("topic_domain").alias("domain"), F.col("topic_tags").alias("tags"), F.col("quality_score").alias("quality"), turns.alias("messages")))


def plain_lines(rows: DataFrame) -> DataFrame:
    """Each row as a line of JSON."""
    return rows.select(_json(*rows.columns))


def manifest(paths: Sequence[tuple[str, str]]) -> list[dict]:
    """Name, SHA-256, bytes and rows of local files; relative paths that climb out of the folder raise."""
    import os

    import pyarrow.parquet as pq

    out = []
    for root, name in paths:
        full = os.path.realpath(os.path.join(root, name))
        if not full.startswith(os.path.realpath(root) + os.sep):
            raise ValueError(f"{name} lies outside of {root}")
        h = hashlib.sha256()
        with open(full, "rb") as f:
            for block in iter(lambda: f.read(1 << 20), b""):
                h.update(block)
        rows = pq.ParquetFile(full).metadata.num_rows if full.endswith(".parquet") else sum(1 for line in open(full, "rb") if line.strip())  # noqa: SIM115
        out.append({"artifact": name, "sha256": h.hexdigest(), "bytes": os.path.getsize(full), "rows": rows})
    return out


def manifest_of_table(spark: SparkSession, path: str) -> DataFrame:
    """``artifact`` (file name), ``sha256``, ``bytes`` and ``rows`` of each file of a Parquet table, read where it lies."""
    name = lambda c: F.regexp_extract(c, "[^/]+$", 0)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(name(F.col("path")).alias("artifact"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    rows = spark.read.parquet(path).select(name(F.col("_metadata.file_path")).alias("artifact")).groupBy("artifact").agg(F.count("*").alias("rows"))
    return files.join(rows, "artifact", "left").select("artifact", "sha256", "bytes", F.coalesce("rows", F.lit(0)).alias("rows"))


def verify_manifest(root: str, entries: Sequence[dict]) -> list[str]:
    """Names of files that are missing or differ from their entries."""
    wrong = []
    for e in entries:
        try:
            now = manifest([(root, e["artifact"])])[0]
        except (OSError, ValueError):
            wrong.append(e["artifact"])
            continue
        if now != {k: e[k] for k in now}:
            wrong.append(e["artifact"])
    return wrong
