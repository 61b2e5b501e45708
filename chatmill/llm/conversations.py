"""Message rows rebuilt into conversations, by assembling overlapping export fragments.

Each stretch of delivered rows is an export page. In it, messages that answer one another in unbroken chains are put
together to fragments: sequences of message hashes, begun by the hash of the message that the first one answers.
Fragments of several pages overlap: what was delivered again lies in the end of one and the beginning of another, and
every fragment begins with a hash that another ends with, or holds. Overlaps are trimmed to that one hash: a message stays
in the fragment of its first delivery. Fragments are cut where several messages answer one, so that all matches are between
a suffix and prefixes. This overlap graph is contracted, unambiguous paths being merged into one step. What hangs together
from a beginning that answers nothing is a conversation; one that begins with an answer to something absent has a gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatmill.operators.hierarchy import resolve_hierarchy
from chatmill.plans.ranks import with_position
from chatmill.plans.scratch import Scratch

#: Rows of an export page that are put together at once; so no fragment is longer.
PAGE_ROWS = 8192
#: Messages of one conversation numbered in one task; longer ones are numbered by ranges of all of them.
STRETCH_ROWS = 100_000
#: Characters that show nothing, besides white space.
UNSEEN = r"\p{Z}\p{Cc}\p{Cf}\x{FE00}-\x{FE0F}\x{2800}\x{3164}\x{115F}\x{1160}\x{34F}"


def visible(text: Column) -> Column:
    """Whether a text has a character that can be seen; false for null."""
    return F.coalesce(text.rlike(rf"[^\s{UNSEEN}]"), F.lit(False))


def message_hash(chat_id: Column, msg_id: Column) -> Column:
    """Hash of a message within its chat. xxhash64 of one long is a bijection, so hashes of a chat never collide."""
    return F.when(chat_id.isNotNull() & msg_id.isNotNull(), F.xxhash64(msg_id.cast("long")))


def chain(chat: np.ndarray, own: np.ndarray, above: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fragment and place of each row of a page: rows follow one another where each is the only answer to the last.

    ``above`` is the hash of what is answered and counts where ``known``. Of rows that repeat a message in the page only the
    first is chained. Circles are begun anywhere.
    """
    n = len(own)
    order = np.lexsort((np.arange(n), own, chat))
    first = np.ones(n, bool)
    first[1:] = (chat[order][1:] != chat[order][:-1]) | (own[order][1:] != own[order][:-1])
    nodes = order[first]  # sorted by chat and hash, each message once
    keys = np.empty(len(nodes), [("c", np.int64), ("h", np.int64)])
    keys["c"], keys["h"] = chat[nodes], own[nodes]
    wanted = np.empty(len(nodes), keys.dtype)
    wanted["c"], wanted["h"] = chat[nodes], above[nodes]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    linked = known[nodes] & (keys[at] == wanted) & (at != np.arange(len(nodes)))
    answers = np.bincount(at[linked], minlength=len(nodes))
    follows = linked & (answers[at] == 1)
    after = np.full(len(nodes), -1)
    after[at[follows]] = np.flatnonzero(follows)
    fragment, place = np.arange(n), np.zeros(n, np.int64)
    done = np.zeros(len(nodes), bool)
    for start in (*np.flatnonzero(~follows).tolist(), *np.flatnonzero(follows).tolist()):
        k, m = start, 0
        while k >= 0 and not done[k]:
            done[k] = True
            fragment[nodes[k]], place[nodes[k]] = nodes[start], m
            k, m = after[k], m + 1
    return fragment, place


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get()
    taken = (task.partitionId() if task else 0) << 40
    for whole in batches:
        for a in range(0, whole.num_rows, PAGE_ROWS):
            page = whole.slice(a, PAGE_ROWS)
            head = page.column("head")
            fragment, place = chain(page.column("chat_id").to_numpy(), page.column("tail").to_numpy(), head.fill_null(0).to_numpy(), head.is_valid().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*page.columns, pa.array(fragment + taken), pa.array(place)], [*page.schema.names, "fragment", "place"])
            taken += page.num_rows


def export_fragments(rows: DataFrame) -> DataFrame:
    """Overlap-free fragments: chat_id, ``head`` (hash of what is answered, null for a beginning), ``tail`` and ``members``.

    Members are (place, hash, prev, msg_id, at, author, seen) in the order of the chain; ``tail`` is the last one's hash. Each
    message is in one fragment, and each head that is present is the tail of one.
    """
    own = rows.where(~F.coalesce(rows["is_service"], F.lit(False)) & F.col("chat_id").isNotNull() & F.col("msg_id").isNotNull())
    own = own.select(
        F.col("chat_id").cast("long").alias("chat_id"), F.col("msg_id").cast("long").alias("msg_id"), F.col("unixtime").alias("at"), F.coalesce("author_id_raw", F.lit("")).alias("author"), visible(F.col("text_raw")).alias("seen"),
        message_hash(F.col("chat_id"), F.col("msg_id")).alias("tail"), F.when(F.col("reply_to_id") != 0, message_hash(F.col("chat_id"), F.col("reply_to_id"))).alias("head"), "batch_id", "ingested_at",
    )
    schema = ", ".join(f"{c} {t}" for c, t in own.dtypes) + ", fragment long, place long"
    pages = own.mapInArrow(_assemble, schema)
    first = F.struct(F.col("batch_id").isNull(), F.col("batch_id"), F.col("ingested_at").isNull(), F.col("ingested_at"), F.col("seen"), F.col("fragment"), F.col("place"))
    # a row tells of its own message and, to the message it answers, that it does
    none = F.lit(None)
    told = F.explode(
        F.array(
            F.struct(F.col("tail").alias("hash"), F.col("msg_id"), F.col("at"), F.col("author"), F.col("head").alias("prev"), first.alias("first"), none.cast("long").alias("answer")),
            F.struct(F.col("head").alias("hash"), none.cast("long").alias("msg_id"), none.cast("long").alias("at"), none.cast("string").alias("author"), none.cast("long").alias("prev"), F.when(F.lit(False), first).alias("first"), F.col("tail").alias("answer")),
        )
    ).alias("x")
    messages = (
        pages.select("chat_id", told)
        .where("x.hash is not null")
        .groupBy("chat_id", F.col("x.hash").alias("hash"))
        .agg(F.min("x.msg_id").alias("msg_id"), F.min("x.at").alias("at"), F.min("x.author").alias("author"), F.min("x.prev").alias("prev"), F.min("x.first").alias("first"), (F.min("x.answer") != F.max("x.answer")).alias("forks"))
        .where("first is not null")
    )
    member = F.struct(F.col("first.place").alias("place"), "hash", "prev", "msg_id", "at", "author", F.col("first.seen").alias("seen"), F.coalesce("forks", F.lit(False)).alias("forks"))
    # a page bounds what is collected
    trimmed = messages.groupBy("chat_id", F.col("first.fragment").alias("fragment")).agg(F.array_sort(F.collect_list(member)).alias("m"))
    begins = F.expr("filter(sequence(1, size(m)), i -> i = 1 or m[i - 2].forks or m[i - 1].prev is null or m[i - 1].prev <> m[i - 2].hash)")
    cut = trimmed.withColumn("b", begins).select("chat_id", F.explode(F.expr("transform(b, (i, k) -> slice(m, i, if(k + 1 < size(b), b[k + 1], size(m) + 1) - i))")).alias("members"))
    return cut.select("chat_id", F.col("members")[0]["prev"].alias("head"), F.element_at("members", -1)["hash"].alias("tail"), "members")


def rebuild_conversations(rows: DataFrame, with_text: bool = False) -> DataFrame:
    """A row for each message of a sound conversation: chat_id, root_id, msg_id, turn_no, speaker_role, maybe content.

    Takes delivered rows with the columns of normalized messages; further columns are ignored. Service messages stand
    apart (a null is_service counts as no). Of copies, the text of the first delivery counts. Rows with a null chat or
    message id are left out. A conversation is dropped if its first message answers an absent one, if it has a loop, a
    message earlier than the one it answers, or one without visible text, or if all its messages have one author id
    (null is the same as empty); so single messages are dropped. Null times sort first and are never earlier.
    turn_no counts from 1 by (unixtime, msg_id); the root's author is the ``user``, all others ``assistant``.
    """
    scratch = Scratch(rows.sparkSession, "conversations")
    fragments = scratch.save("fragments", export_fragments(rows))
    # suffix-prefix matches are by the one hash that trimming left; paths without forks are merged by the contraction
    tree = resolve_hierarchy(fragments.select("chat_id", "tail", "head"), "chat_id", "tail", "head", no_parent=()).where("not cyclic").select("chat_id", "tail", F.col("root_id").alias("origin"))
    ends = fragments.select("chat_id", F.col("tail").alias("head"), F.element_at("members", -1)["at"].alias("before"))
    within = F.expr("exists(sequence(1, size(members)), i -> coalesce(members[i - 1].at < if(i = 1, before, members[i - 2].at), false))")
    linked = fragments.join(tree, ["chat_id", "tail"]).join(ends, ["chat_id", "head"], "left").withColumn("early", within)
    begins = F.col("tail") == F.col("origin")
    sound = (
        linked.select("chat_id", "origin", "early", "members", begins.alias("begins"), F.col("head").isNotNull().alias("answers"))
        .groupBy("chat_id", "origin")
        .agg(
            F.sum(F.size("members")).alias("many"),
            F.min(F.when(F.col("begins"), F.col("members")[0]["msg_id"])).alias("root_id"),
            F.min(F.when(F.col("begins"), F.col("members")[0]["author"])).alias("asker"),
            F.max(F.col("begins") & F.col("answers")).alias("gap"),
            F.max("early").alias("early"),
            F.min(F.forall("members", lambda m: m["seen"])).alias("seen"),
            (F.min(F.array_min(F.col("members.author"))) != F.max(F.array_max(F.col("members.author")))).alias("several"),
        )
        .where("not gap and not early and seen and several")
        .select("chat_id", "origin", "many", "root_id", "asker")
    )
    kept = fragments.join(tree, ["chat_id", "tail"]).join(sound, ["chat_id", "origin"]).select("chat_id", "root_id", "many", "asker", F.explode("members").alias("m"))
    role = F.when(F.col("m.author") == F.col("asker"), "user").otherwise("assistant").alias("speaker_role")
    kept = scratch.save("kept", kept.select("chat_id", "root_id", F.col("m.msg_id").alias("msg_id"), F.col("m.at").alias("at"), "many", role))
    scratch.drop("fragments")
    turn = F.row_number().over(Window.partitionBy("chat_id", "root_id").orderBy("at", "msg_id"))
    columns = ["chat_id", "root_id", "msg_id", F.col("turn").cast("long").alias("turn_no"), "speaker_role"]
    out = kept.where(F.col("many") <= STRETCH_ROWS).withColumn("turn", turn).select(*columns)
    long = kept.where(F.col("many") > STRETCH_ROWS)
    if not long.isEmpty():
        placed = scratch.save("placed", with_position(long, [F.col("chat_id"), F.col("root_id"), F.col("at"), F.col("msg_id")], "position"))
        since = placed.groupBy("chat_id", "root_id").agg(F.min("position").alias("since"))
        out = out.unionByName(placed.join(since, ["chat_id", "root_id"]).withColumn("turn", F.col("position") - F.col("since") + 1).select(*columns))
    if not with_text:
        return out
    # texts travel once
    delivery = F.struct(F.col("batch_id").isNull(), F.col("batch_id"), F.col("ingested_at").isNull(), F.col("ingested_at"), F.col("text_raw"))
    own = rows.where(~F.coalesce(rows["is_service"], F.lit(False)) & F.col("chat_id").isNotNull() & F.col("msg_id").isNotNull())
    texts = own.groupBy("chat_id", "msg_id").agg(F.min(delivery).alias("first")).select("chat_id", "msg_id", F.col("first.text_raw").alias("content"))
    return out.join(texts, ["chat_id", "msg_id"]).select("chat_id", "root_id", "msg_id", "turn_no", "speaker_role", "content")
