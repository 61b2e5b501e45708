"""Streaming forms of operators; the batch forms are authoritative."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.text import normalized


def deduplicated(stream: DataFrame, text: str, time: str, delay: str = "1 day") -> DataFrame:
    """Drops texts that came before within the delay; the first to arrive stays."""
    return stream.withColumn("_key", F.md5(normalized(F.col(text)))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def redeliveries(stream: DataFrame, keys: list[str], time: str, delay: str = "3 days") -> DataFrame:
    """Drops copies of a message within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def bursts(stream: DataFrame, chat: str, time: str, gap: str = "300 seconds", delay: str = "10 minutes") -> DataFrame:
    """Runs of messages of a chat with no longer gap, with their size."""
    found = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), F.col(chat)).agg(F.count("*").alias("messages"))
    return found.select(chat, F.col("w.start").alias("since"), F.col("w.end").alias("until"), "messages")


def reply_links(stream: DataFrame, time: str, hours: int = 48) -> DataFrame:
    """Messages with the message they answer, if that is at most ``hours`` older."""
    parent = stream.select(F.col("chat_id").alias("p_chat"), F.col("msg_id").alias("parent_id"), F.col(time).alias("p_time")).withWatermark("p_time", f"{hours} hours")
    child = stream.where("reply_to_id <> 0").withWatermark(time, f"{hours} hours")
    near = F.expr(f"chat_id = p_chat and reply_to_id = parent_id and {time} >= p_time and {time} <= p_time + interval {hours} hours")
    return child.join(parent, near).select("chat_id", "msg_id", "parent_id", time)


def hourly_volume(stream: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """Messages an hour."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, "1 hour").alias("w")).agg(F.count("*").alias("messages")).select(F.col("w.start").alias("hour"), "messages")
