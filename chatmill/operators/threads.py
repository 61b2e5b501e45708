"""Discussion threads: reply trees, bursts of messages close in time, and single messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatmill.operators.hierarchy import resolve_hierarchy
from chatmill.plans.ranks import with_position, with_previous, with_running_sum
from chatmill.plans.scratch import Scratch

REPLY_HOURS, BURST_SECONDS = 48, 300


def reply_links(rows: DataFrame, hours: int = REPLY_HOURS) -> DataFrame:
    """chat_id, msg_id, parent_id of messages that answer an existing message of their chat within the time limit.

    An answer before its parent's time doesn't count, nor does the parent id 0.
    """
    parent = rows.select("chat_id", F.col("msg_id").alias("parent_id"), F.col("unixtime").alias("_before"))
    child = rows.where("reply_to_id is not null and reply_to_id <> 0").select("chat_id", "msg_id", F.col("reply_to_id").cast("long").alias("parent_id"), "unixtime")
    linked = child.join(parent, ["chat_id", "parent_id"])
    return linked.where((F.col("unixtime") >= F.col("_before")) & (F.col("unixtime") - F.col("_before") <= hours * 3600)).select("chat_id", "msg_id", "parent_id")


#: Messages of a thread that are numbered in one task; longer threads are numbered by ranges.
THREAD_ROWS = 100_000


def build_threads(rows: DataFrame, hours: int = REPLY_HOURS, burst: int = BURST_SECONDS) -> DataFrame:
    """``thread_id``, ``kind`` (tree, burst, single), chat_id, msg_id, ``pos`` within the thread for each message.

    Takes chat_id, msg_id, unixtime, reply_to_id with unique (chat_id, msg_id). A tree is what hangs below a message
    with replies and without parent; messages in a loop of replies are in no tree. A burst is a run of other messages of a
    chat, ordered by (unixtime, msg_id), with gaps of at most ``burst`` seconds and no tree message in between; runs of
    one are singles. Threads are numbered from 1: trees by (chat, time, id) of their root, then bursts by those of their
    first message, then singles. Rows with a null chat, id or time are left out.
    """
    scratch = Scratch(rows.sparkSession, "threads")
    own = scratch.save("own", rows.select("chat_id", "msg_id", "unixtime", "reply_to_id").where("chat_id is not null and msg_id is not null and unixtime is not null"))
    links = reply_links(own, hours)
    tree = resolve_hierarchy(own.select("chat_id", "msg_id").join(links, ["chat_id", "msg_id"], "left"), "chat_id", "msg_id", "parent_id", no_parent=())
    parents = links.select("chat_id", F.col("parent_id").alias("msg_id")).distinct().withColumn("_has", F.lit(True))
    flagged = own.join(tree.select("chat_id", "msg_id", "root_id", "depth", "cyclic"), ["chat_id", "msg_id"]).join(parents, ["chat_id", "msg_id"], "left")
    flagged = flagged.withColumn("in_tree", ~F.col("cyclic") & ((F.col("depth") > 0) | F.coalesce("_has", F.lit(False))))
    ordered = with_previous(flagged, [F.col("chat_id"), F.col("unixtime"), F.col("msg_id")], ["chat_id", "in_tree", "unixtime"])
    # a run breaks at another chat, after a tree message and after a gap; runs are numbered through all chats
    same = F.coalesce((F.col("prev_chat_id") == F.col("chat_id")) & ~F.col("prev_in_tree") & (F.col("unixtime") - F.col("prev_unixtime") <= burst), F.lit(False))
    marked = ordered.withColumn("_break", F.when(~F.col("in_tree") & ~same, 1).otherwise(0))
    runs = with_running_sum(marked.select("chat_id", "msg_id", "unixtime", "depth", "in_tree", "root_id", "place", "_break"), [F.col("place")], "_break", "_run")
    runs = scratch.save("runs", runs.withColumn("group", F.when(F.col("in_tree"), F.col("root_id")).otherwise(-F.col("_run"))).select("chat_id", "msg_id", "unixtime", "depth", "in_tree", "group"))
    root = F.when(~F.col("in_tree") | (F.col("depth") == 0), F.struct("unixtime", "msg_id"))
    groups = runs.groupBy("chat_id", "in_tree", "group").agg(F.count("*").alias("n"), F.min(root).alias("first"))
    rank = F.when(F.col("in_tree"), 0).when(F.col("n") > 1, 1).otherwise(2)
    numbered = with_position(groups.withColumn("_kind", rank), [F.col("_kind"), F.when(F.col("_kind") < 2, F.col("chat_id")), F.col("first.unixtime"), F.col("first.msg_id"), F.col("chat_id")], "thread_id", first=1)
    kind = F.element_at(F.array(F.lit("tree"), F.lit("burst"), F.lit("single")), F.col("_kind") + 1)
    placed = scratch.save("members", runs.join(numbered.select("chat_id", "in_tree", "group", "n", "thread_id", kind.alias("kind")), ["chat_id", "in_tree", "group"]))
    pos = F.row_number().over(Window.partitionBy("thread_id").orderBy("unixtime", "depth", "msg_id"))
    columns = ["thread_id", "kind", "chat_id", "msg_id", F.col("pos").cast("long").alias("pos")]
    out = placed.where(F.col("n") <= THREAD_ROWS).withColumn("pos", pos).select(*columns)
    long = placed.where(F.col("n") > THREAD_ROWS)
    if not long.isEmpty():
        ranked = scratch.save("long", with_position(long, [F.col("thread_id"), F.col("unixtime"), F.col("depth"), F.col("msg_id")], "_at"))
        since = ranked.groupBy("thread_id").agg(F.min("_at").alias("_since"))
        out = out.unionByName(ranked.join(since, "thread_id").withColumn("pos", F.col("_at") - F.col("_since") + 1).select(*columns))
    return out
