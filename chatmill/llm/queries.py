"""Queries of the text operators, with the SQL they are held against."""

from __future__ import annotations

import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatmill.llm.conversations import rebuild_conversations
from chatmill.llm.leakage import leaked_items
from chatmill.llm.packing import pack, token_counts
from chatmill.llm.pairs import answers_of, flag_answers
from chatmill.llm.personal import KINDS, mask_personal, personal_fields
from chatmill.llm.shared_spans import shared_fraction, shared_spans
from chatmill.llm.splitting import split_items
from chatmill.llm.subjects import assign_subjects, composition
from chatmill.sources.tables import table


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return shared_spans(table(spark, sf, "documents"))


def p10_shared_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return shared_fraction(table(spark, sf, "documents"))


TOKENIZER = os.environ.get("CHATMILL_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def _subjects(spark: SparkSession, sf: str) -> DataFrame:
    return assign_subjects(table(spark, sf, "full_clean_messages"), table(spark, sf, "subject_labels"), table(spark, sf, "subject_areas"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _subjects(spark, sf).select("chat_id", "msg_id", F.explode("subjects").alias("subject")).distinct()


def p1_composition(spark: SparkSession, sf: str) -> DataFrame:
    return composition(_subjects(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    answers = answers_of(table(spark, sf, "dpo_preference_pairs"), table(spark, sf, "sft_dialogues"))
    return flag_answers(answers, ["src", "rec_id", "slot"])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    raw, clean = table(spark, sf, "normalized_messages"), table(spark, sf, "full_clean_messages")
    keys = ["chat_id", "msg_id"]
    return personal_fields([(raw, keys, "text_raw"), (raw, keys, "author_raw"), (clean, keys, "text_clean")])


def p4_masked(spark: SparkSession, sf: str) -> DataFrame:
    return mask_personal(table(spark, sf, "full_clean_messages"), ["chat_id", "msg_id"], "text_clean")


def p4_unchanged(spark: SparkSession, sf: str) -> DataFrame:
    """Whether what stands between the placeholders of a masked message is its text, in order and complete."""

    def unchanged(texts: pd.Series, masks: pd.Series) -> pd.Series:
        mark = re.compile("|".join(rf"\[{k}\]" for k in KINDS))

        def one(text: str | None, mask: str | None) -> bool:
            if text is None or mask is None:
                return text is mask
            shape = ".+?".join(re.escape(x) for x in mark.split(mask))
            return text == mask or re.fullmatch(shape, text, re.S) is not None

        return pd.Series([one(t, m) for t, m in zip(texts, masks, strict=True)])

    rows = table(spark, sf, "full_clean_messages")
    masked = mask_personal(rows.select("chat_id", "msg_id", F.col("text_clean").alias("_text"), "text_clean"), ["chat_id", "msg_id", "_text"], "text_clean")
    return masked.select("chat_id", "msg_id", F.pandas_udf(unchanged, "boolean")("_text", "text_masked").alias("unchanged"))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    messages = split_items(table(spark, sf, "full_clean_messages"), ["chat_id", "msg_id"], "text_clean", 1200)
    records = split_items(table(spark, sf, "jsonl_records"), ["rec_id"], "record", 4000, kind="json")
    cols = ["piece_no", "piece_begin", "piece_end", "piece", "n_pieces"]
    messages = messages.select(F.lit("full_clean_messages").alias("src"), "chat_id", F.col("msg_id").alias("item_id"), *cols)
    return messages.unionByName(records.select(F.lit("jsonl_records").alias("src"), F.lit(0).cast("long").alias("chat_id"), F.col("rec_id").alias("item_id"), *cols))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).where("n_pieces > 1 and piece_no = 0").select("src", "chat_id", "item_id")


def p6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf)


def p6_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Each item put together again from its pieces, and whether they keep limit and overlap."""
    p = _split(spark, sf)
    limit = F.when(F.col("src") == "jsonl_records", 4000).otherwise(1200)
    along = F.array_sort(F.collect_list(F.struct("piece_no", "piece_begin", "piece_end", "piece")))
    one = p.groupBy("src", "chat_id", "item_id").agg(along.alias("p"), F.max(F.length("piece") > limit).alias("long"), F.max("n_pieces").alias("n"))
    # the overlap of a piece is what its predecessor ends with
    begins = F.transform("p", lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substring(x["piece"], 101, F.length(x["piece"]))))
    overlaps = F.forall("p", lambda x: (x["piece_no"] == 0) | (F.left(x["piece"], F.lit(100)) == F.right(F.get("p", x["piece_no"].cast("int") - 1)["piece"], F.lit(100))))
    return one.select("src", "chat_id", "item_id", F.md5(F.array_join(begins, "")).alias("whole_md5"), (~F.col("long")).alias("within_limit"), overlaps.alias("overlaps"), (F.size("p") == F.col("n")).alias("complete"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return rebuild_conversations(table(spark, sf, "normalized_messages"))


def p7_turns(spark: SparkSession, sf: str) -> DataFrame:
    return rebuild_conversations(table(spark, sf, "normalized_messages"), with_text=True)


def p8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(token_counts(table(spark, sf, "documents"), "doc_id", "text", TOKENIZER))


def p8_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Each document, whether its parts join without gaps, and whether it is whole unless it exceeds the capacity."""
    p = p8_packing(spark, sf).withColumn("before", F.lag("part_end").over(Window.partitionBy("doc_id").orderBy("part_begin", "part_end")))
    one = p.groupBy("doc_id").agg(F.min(F.col("part_begin") == F.coalesce("before", F.lit(0))).alias("joined"), F.count("*").alias("n"), F.max("part_end").alias("size"))
    return one.select("doc_id", "joined", (F.col("n") == F.greatest(F.ceil(F.col("size") / 4096), F.lit(1))).alias("whole"))


def p8_filling(spark: SparkSession, sf: str) -> DataFrame:
    """One row: whether all containers keep the capacity, and whether at most a twentieth more are used than the sum needs."""
    loads = p8_packing(spark, sf).groupBy("container_id").agg(F.sum(F.col("part_end") - F.col("part_begin")).alias("load"))
    least = F.ceil(F.sum("load") / 4096)
    return loads.agg((F.max("load") <= 4096).alias("within_capacity"), (F.count("*") <= F.greatest(least * 1.05, least + 1)).alias("filled"))


QUERIES = {"p1_found": p1_found, "p1_composition": p1_composition, "p3_found": p3_found, "p4_found": p4_found, "p4_masked": p4_masked, "p4_unchanged": p4_unchanged, "p6_found": p6_found, "p6_pieces": p6_pieces, "p6_checked": p6_checked, "p7_found": p7_found, "p7_turns": p7_turns, "p8_packing": p8_packing, "p8_checked": p8_checked, "p8_filling": p8_filling, "p9_found": p9_found, "p10_found": p10_found, "p10_shared_fraction": p10_shared_fraction}

_CONVERSATIONS = r"""
WITH RECURSIVE m AS (SELECT chat_id, msg_id, min(unixtime) AS ts, min(coalesce(author_id_raw, '')) AS author, min(nullif(reply_to_id, 0)) AS r,
  arg_min(coalesce(regexp_matches(text_raw, '[^\s\p{Z}\p{Cc}\p{Cf}\x{FE00}-\x{FE0F}\x{2800}\x{3164}\x{115F}\x{1160}\x{34F}]'), false), {'b': batch_id, 'i': ingested_at}) AS seen
  FROM normalized_messages WHERE NOT coalesce(is_service, false) AND chat_id IS NOT NULL AND msg_id IS NOT NULL GROUP BY chat_id, msg_id),
t AS (SELECT chat_id, msg_id, ts, author, seen, msg_id AS root_id, author AS asker, r IS NOT NULL AS gap, false AS early
  FROM m WHERE r IS NULL OR NOT EXISTS (SELECT 1 FROM m b WHERE b.chat_id = m.chat_id AND b.msg_id = m.r)
  UNION ALL SELECT m.chat_id, m.msg_id, m.ts, m.author, m.seen, t.root_id, t.asker, t.gap, m.ts < t.ts
  FROM t JOIN m ON m.chat_id = t.chat_id AND m.r = t.msg_id),
k AS (SELECT chat_id, root_id FROM t GROUP BY chat_id, root_id
  HAVING NOT bool_or(gap) AND NOT bool_or(coalesce(early, false)) AND bool_and(seen) AND min(author) <> max(author))
SELECT t.chat_id, t.root_id, t.msg_id, row_number() OVER (PARTITION BY t.chat_id, t.root_id ORDER BY t.ts, t.msg_id) AS turn_no,
  CASE WHEN t.author = t.asker THEN 'user' ELSE 'assistant' END AS speaker_role FROM t JOIN k USING (chat_id, root_id)"""

_SPANS = """w AS (SELECT doc_id, text, unnest(range(0, length(text) - 279)) AS i FROM documents WHERE length(text) >= 280 AND doc_id IS NOT NULL),
h AS (SELECT doc_id, i, md5(substring(text, CAST(i + 1 AS BIGINT), 280)) AS m FROM w), k AS (SELECT m FROM h GROUP BY m HAVING min(doc_id) < max(doc_id)), s AS (SELECT DISTINCT doc_id, i FROM h JOIN k USING (m)),
b AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 280 THEN 0 ELSE 1 END AS b FROM s), g AS (SELECT doc_id, i, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM b),
r AS (SELECT doc_id, min(i) AS span_begin, max(i) + 280 AS span_end FROM g GROUP BY doc_id, g)"""

SQL = {
    "p4_unchanged": "SELECT chat_id, msg_id, true AS unchanged FROM full_clean_messages",
    "p10_found": f"WITH {_SPANS} SELECT * FROM r",
    "p10_shared_fraction": f"""WITH {_SPANS}, c AS (SELECT doc_id, sum(span_end - span_begin) AS s, count(*) AS n FROM r GROUP BY doc_id), d AS (SELECT doc_id, max(length(coalesce(text, ''))) AS chars FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id)
SELECT doc_id, chars, CAST(coalesce(s, 0) AS BIGINT) AS shared_chars, coalesce(n, 0) AS shared_runs, CASE WHEN chars > 0 THEN coalesce(s, 0) / CAST(chars AS DOUBLE) ELSE 0 END AS shared_fraction FROM d LEFT JOIN c USING (doc_id)""",
    "p6_checked": """SELECT 'full_clean_messages' AS src, chat_id, msg_id AS item_id, md5(text_clean) AS whole_md5, true AS within_limit, true AS overlaps, true AS complete FROM full_clean_messages WHERE text_clean IS NOT NULL
UNION ALL SELECT 'jsonl_records', CAST(0 AS BIGINT), rec_id, md5(record), true, true, true FROM jsonl_records WHERE record IS NOT NULL""",
    "p8_checked": "SELECT DISTINCT doc_id, true AS joined, true AS whole FROM documents WHERE doc_id IS NOT NULL",
    "p8_filling": "SELECT true AS within_capacity, true AS filled",
    "p7_found": _CONVERSATIONS,
    "p7_turns": f"""WITH c AS ({_CONVERSATIONS}), x AS (SELECT chat_id, msg_id, list(text_raw ORDER BY batch_id NULLS LAST, ingested_at NULLS LAST, text_raw NULLS FIRST)[1] AS content
  FROM normalized_messages WHERE NOT coalesce(is_service, false) GROUP BY chat_id, msg_id)
SELECT c.*, x.content FROM c JOIN x USING (chat_id, msg_id)""",
    "p6_found": """SELECT 'full_clean_messages' AS src, chat_id, msg_id AS item_id FROM full_clean_messages WHERE length(text_clean) > 1200
UNION ALL SELECT 'jsonl_records', CAST(0 AS BIGINT), rec_id FROM jsonl_records WHERE length(record) > 4000""",
    "p9_found": r"""
WITH folded AS (
  SELECT 0 AS kind, doc_id AS id, text AS t FROM documents UNION ALL SELECT 1, item_id, body FROM eval_items),
words AS (SELECT kind, id, list_filter(string_split_regex(translate(strip_accents(lower(regexp_replace(t, '[\p{Cf}\p{Mn}\p{Me}]', '', 'g'))),
  'авсеёніјкмоѕртух', 'abceehijkmosptyx'), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws FROM folded),
grams AS (SELECT kind, id, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS g FROM words WHERE len(ws) >= 8),
items AS (SELECT DISTINCT id, g FROM grams WHERE kind = 1)
SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM grams d JOIN items i ON d.g = i.g WHERE d.kind = 0""",
}
