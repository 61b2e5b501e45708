"""Who talks to whom: interaction edges and measures of their graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatmill.plans.ranks import with_position


def interactions(rows: DataFrame, minutes: int = 30) -> DataFrame:
    """``sender`` and ``recipient`` of each message that answers somebody else, one row a message.

    A reply to an existing message of the chat goes to its author. Any other message goes to the author of the message
    before it in the order of all messages (time, chat, id), if that is of the same chat and at most ``minutes`` old.
    A message goes to nobody if that would be its own author; a reply to oneself does not fall back. Positions are found by
    ranges, so the order over all chats doesn't gather in one task. Rows with a null chat, id or time are left out.
    """
    own = rows.where("chat_id is not null and msg_id is not null and unixtime is not null").select("chat_id", "msg_id", "unixtime", F.coalesce("author_anon", F.lit("")).alias("sender"), F.col("reply_to_id").cast("long").alias("reply_to_id"))
    placed = with_position(own, [F.col("unixtime"), F.col("chat_id"), F.col("msg_id")], "place")
    target = own.groupBy("chat_id", F.col("msg_id").alias("reply_to_id")).agg(F.max("sender").alias("answered"))
    before = placed.select((F.col("place") + 1).alias("place"), F.col("chat_id").alias("before_chat"), F.col("unixtime").alias("before_time"), F.col("sender").alias("before_sender"))
    both = placed.join(target, ["chat_id", "reply_to_id"], "left").join(before, "place", "left")
    near = (F.col("before_chat") == F.col("chat_id")) & (F.col("unixtime") - F.col("before_time") <= minutes * 60)
    recipient = F.when(F.col("answered").isNotNull(), F.col("answered")).when(near, F.col("before_sender"))
    return both.select("sender", recipient.alias("recipient")).where("recipient is not null and recipient <> sender")


def edges(talk: DataFrame) -> DataFrame:
    return talk.groupBy("sender", "recipient").agg(F.count("*").alias("weight"))


def degrees(edge: DataFrame) -> DataFrame:
    """``author``, replies received and given."""
    both = edge.select(F.col("recipient").alias("author"), F.col("weight").alias("received"), F.lit(0).cast("long").alias("given")).unionByName(edge.select(F.col("sender").alias("author"), F.lit(0).cast("long").alias("received"), F.col("weight").alias("given")))
    return both.groupBy("author").agg(F.sum("received").alias("received"), F.sum("given").alias("given"))


def mutual_pairs(edge: DataFrame) -> DataFrame:
    """``user_a`` < ``user_b`` and the sum of both weights, of pairs that answer each other."""
    pair = edge.select(F.least("sender", "recipient").alias("user_a"), F.greatest("sender", "recipient").alias("user_b"), "weight")
    return pair.groupBy("user_a", "user_b").agg(F.count("*").alias("n"), F.sum("weight").alias("total")).where("n = 2").select("user_a", "user_b", "total")


def graph_measures(edge: DataFrame) -> DataFrame:
    """One row: nodes, edges, interactions, density and mutual pairs."""
    nodes = degrees(edge).agg(F.count("*").alias("nodes"))
    sums = edge.agg(F.count("*").alias("edges"), F.coalesce(F.sum("weight"), F.lit(0)).alias("interactions"))
    pairs = mutual_pairs(edge).agg(F.count("*").alias("mutual_pairs"))
    possible = F.when(F.col("nodes") > 1, F.col("nodes") * (F.col("nodes") - 1)).otherwise(1)
    return nodes.crossJoin(F.broadcast(sums)).crossJoin(F.broadcast(pairs)).withColumn("density", F.col("edges") / possible)


def top_degrees(edge: DataFrame, most: int = 15) -> DataFrame:
    """``kind`` (received, given), ``place``, ``author`` and ``n`` of those who get and give most replies; ties by name."""
    both = degrees(edge)
    out = None
    for kind in ("received", "given"):
        # the limit keeps what is numbered small
        some = both.where(F.col(kind) > 0).orderBy(F.desc(kind), "author").limit(most)
        part = some.select(F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(F.desc(kind), "author")).alias("place"), "author", F.col(kind).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def strong_pairs(edge: DataFrame, least: int = 10, most: int = 12) -> DataFrame:
    """The pairs with the most replies to each other, at least ``least``; ties by names."""
    return mutual_pairs(edge).where(F.col("total") >= least).orderBy(F.desc("total"), "user_a", "user_b").limit(most)
