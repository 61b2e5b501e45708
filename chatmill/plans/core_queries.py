"""Queries of the two general delivery and hierarchy operators, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.operators.hierarchy import descendants, intervals, resolve_hierarchy
from chatmill.operators.redelivery import deduplicate_deliveries
from chatmill.sources.tables import path, table

_TREE = """
WITH RECURSIVE m AS (SELECT chat_id, msg_id, CASE WHEN min(reply_to_id) = 0 THEN NULL ELSE min(reply_to_id) END AS r
  FROM normalized_messages WHERE chat_id IS NOT NULL AND msg_id IS NOT NULL GROUP BY chat_id, msg_id),
e AS (SELECT a.chat_id, a.msg_id, a.r FROM m a JOIN m b ON a.chat_id = b.chat_id AND a.r = b.msg_id),
t AS (SELECT m.chat_id, m.msg_id, m.msg_id AS root_id, CAST(0 AS BIGINT) AS depth, CAST(m.msg_id AS VARCHAR) AS path
  FROM m LEFT JOIN e USING (chat_id, msg_id) WHERE e.r IS NULL
  UNION ALL SELECT e.chat_id, e.msg_id, t.root_id, t.depth + 1, t.path || '/' || CAST(e.msg_id AS VARCHAR)
  FROM t JOIN e ON e.chat_id = t.chat_id AND e.r = t.msg_id)
"""


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    kept = deduplicate_deliveries(spark, path(sf, "normalized_messages"), columns=["chat_id", "msg_id"])
    return kept.where("redelivered").select("chat_id", "msg_id")


def p2_unique(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate_deliveries(spark, path(sf, "normalized_messages"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    tree = resolve_hierarchy(table(spark, sf, "normalized_messages"))
    return tree.where("reply_to_id is not null").select("chat_id", "msg_id", F.coalesce("root_id", F.lit(-1)).alias("root_id"), "depth")


def p5_paths(spark: SparkSession, sf: str) -> DataFrame:
    tree = resolve_hierarchy(table(spark, sf, "normalized_messages"), with_path=True)
    return tree.select("chat_id", "msg_id", "root_id", "depth", "cyclic", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"))


def p5_descendants(spark: SparkSession, sf: str) -> DataFrame:
    return descendants(resolve_hierarchy(table(spark, sf, "normalized_messages"), with_path=True))


def p5_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return intervals(resolve_hierarchy(table(spark, sf, "normalized_messages"), with_path=True))


QUERIES = {"p2_found": p2_found, "p2_unique": p2_unique, "p5_found": p5_found, "p5_paths": p5_paths, "p5_descendants": p5_descendants, "p5_intervals": p5_intervals}

SQL = {
    "p2_found": "SELECT chat_id, msg_id FROM normalized_messages WHERE chat_id IS NOT NULL AND msg_id IS NOT NULL GROUP BY chat_id, msg_id HAVING count(*) > 1",
    "p2_unique": """SELECT * EXCLUDE (r, c), coalesce(c > 1, false) AS redelivered FROM (SELECT *, CASE WHEN chat_id IS NULL OR msg_id IS NULL THEN 1 ELSE row_number() OVER w END AS r,
  CASE WHEN chat_id IS NULL OR msg_id IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY chat_id, msg_id) END AS c
  FROM normalized_messages WINDOW w AS (PARTITION BY chat_id, msg_id ORDER BY batch_id NULLS LAST, ingested_at NULLS LAST)) WHERE r = 1""",
    "p5_found": _TREE
    + """SELECT m.chat_id, m.msg_id, coalesce(t.root_id, -1) AS root_id, coalesce(t.depth, -1) AS depth
  FROM m LEFT JOIN t USING (chat_id, msg_id) WHERE m.r IS NOT NULL""",
    "p5_paths": _TREE
    + """SELECT m.chat_id, m.msg_id, t.root_id, coalesce(t.depth, -1) AS depth, t.depth IS NULL AS cyclic, t.path
  FROM m LEFT JOIN t USING (chat_id, msg_id)""",
    "p5_intervals": """
WITH RECURSIVE m AS (SELECT chat_id, msg_id, min(nullif(reply_to_id, 0)) AS r FROM normalized_messages GROUP BY chat_id, msg_id),
e AS (SELECT a.chat_id, a.msg_id, a.r FROM m a JOIN m b ON a.chat_id = b.chat_id AND a.r = b.msg_id),
t AS (SELECT m.chat_id, m.msg_id, [m.msg_id] AS path FROM m LEFT JOIN e USING (chat_id, msg_id) WHERE e.r IS NULL
  UNION ALL SELECT e.chat_id, e.msg_id, list_append(t.path, e.msg_id) FROM t JOIN e ON e.chat_id = t.chat_id AND e.r = t.msg_id),
n AS (SELECT chat_id, msg_id, count(*) AS n FROM (SELECT chat_id, unnest(path) AS msg_id FROM t) GROUP BY chat_id, msg_id), p AS (SELECT chat_id, msg_id, row_number() OVER (ORDER BY chat_id, path) - 1 AS enter FROM t)
SELECT chat_id, msg_id, enter, enter + n - 1 AS leave FROM p JOIN n USING (chat_id, msg_id)""",
    "p5_descendants": """
WITH RECURSIVE m AS (SELECT chat_id, msg_id, min(nullif(reply_to_id, 0)) AS r FROM normalized_messages GROUP BY chat_id, msg_id),
e AS (SELECT a.chat_id, a.msg_id, a.r FROM m a JOIN m b ON a.chat_id = b.chat_id AND a.r = b.msg_id),
t AS (SELECT m.chat_id, m.msg_id FROM m LEFT JOIN e USING (chat_id, msg_id) WHERE e.r IS NULL
  UNION ALL SELECT e.chat_id, e.msg_id FROM t JOIN e ON e.chat_id = t.chat_id AND e.r = t.msg_id),
d AS (SELECT e.chat_id, e.r AS ancestor_id, e.msg_id AS descendant_id, CAST(1 AS BIGINT) AS distance FROM e JOIN t USING (chat_id, msg_id)
  UNION ALL SELECT d.chat_id, e.r, d.descendant_id, d.distance + 1 FROM d JOIN e ON e.chat_id = d.chat_id AND e.msg_id = d.ancestor_id)
SELECT chat_id, ancestor_id, descendant_id, distance FROM d""",
}
