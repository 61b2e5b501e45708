"""Subject areas of messages: averaged word and subword embeddings with independent logistic outputs.

A statement is the mean of its words, a word the mean of the embeddings of itself and of its letter groups; each
subject has a logistic output of its own. A message has a subject if one of its statements has, so the training
likelihood of a message joins its statements by a noisy or: what a message says beside its subject needs no labels. In
each round every partition computes the gradient of its share, the gradients are summed, and one step is taken with
the sum. Scoring reads all messages once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.llm.codes import Words, chunks, mix
from chatmill.plans.scratch import Scratch

TABLE_BITS = 15
DIMENSIONS = 24
#: Labelled messages the model is fitted on at most: those with the least hash of their key. Scoring covers all messages.
MOST_LABELLED = 12_000
ROUNDS = 60
THRESHOLD = 0.3
#: Shares the labelled messages are split into; each is one task of a round.
SHARES = 8
SCORE_CHARS = 1 << 20
_ENDS = np.array([ord(c) for c in ".!?…\n"], np.uint32)
_BLANK = np.array([ord(c) for c in " \n\t\r "], np.uint32)


class Statements:
    """Words of the statements of several texts, with the features of each word."""

    def __init__(self, texts: Sequence[str | None]):
        w = Words(texts)
        self.count = len(w.hash)
        raw = w.raw
        following = np.concatenate((raw[1:], np.zeros(1, np.uint32))) if len(raw) else raw
        ends = np.isin(raw, _ENDS) & (np.isin(following, _BLANK) | (raw == ord("\n")) | (following == 0))
        number = np.cumsum(ends | (raw == 0))
        # numbers say nothing about a subject
        first = w.letters[w.begin] if self.count else np.zeros(0, np.uint32)
        keep = ~((first >= ord("0")) & (first <= ord("9")))
        self.text = w.text[keep]
        self.begin, self.end, self.hash = w.begin[keep], w.end[keep], w.hash[keep]
        at = number[w.place[keep]]
        self.statement = np.cumsum(np.concatenate(([0], (at[1:] != at[:-1]) | (self.text[1:] != self.text[:-1])))) if len(at) else np.zeros(0, np.int64)
        self.word_feature = (mix(self.hash) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.letters = w.letters

    def features(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of the given words and to which of them each belongs, in order: the word, groups of three and four letters.

        A group of three begins one letter before each letter of the word, one of four at all but the last of those
        places; the borders of the word count as a letter.
        """
        letters = np.concatenate((np.zeros(1, np.uint32), self.letters, np.zeros(3, np.uint32)))
        begin, size = self.begin[words], self.end[words] - self.begin[words]
        own = np.arange(len(words))
        parts, owner = [self.word_feature[words]], [own]
        for width, many in ((3, size), (4, np.maximum(size - 1, 1))):
            at = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            h = np.full(len(at), width, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(width):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + letters[at + k].astype(np.uint64)
            parts.append((mix(h) >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
            owner.append(np.repeat(own, many))
        feature, owner = np.concatenate(parts), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return feature[order], owner[order]

    def __len__(self) -> int:
        return int(self.statement[-1]) + 1 if len(self.statement) else 0


class Share:
    """Statements of labelled messages, ready for gradients."""

    def __init__(self, texts: Sequence[str], labels: np.ndarray):
        s = Statements(texts)
        self.labels = labels
        self.n = len(s)
        _, first, self.word = np.unique(s.hash, return_index=True, return_inverse=True)
        self.feature, owner = s.features(first)
        self.feature_start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
        self.feature_count = np.bincount(owner, minlength=len(first)).astype(np.float32)
        self.by_feature = np.argsort(self.feature, kind="stable")
        sorted_ = self.feature[self.by_feature]
        self.used_start = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1]))) if len(sorted_) else sorted_
        self.used = sorted_[self.used_start]
        self.owner = owner
        self.by_word = np.argsort(self.word, kind="stable")
        self.word_start = np.flatnonzero(np.concatenate(([True], self.word[self.by_word][1:] != self.word[self.by_word][:-1]))) if self.n else self.word
        self.statement = s.statement
        self.statement_start = np.flatnonzero(np.concatenate(([True], s.statement[1:] != s.statement[:-1]))) if self.n else s.statement
        self.statement_words = np.bincount(s.statement, minlength=self.n).astype(np.float32)
        self.message = s.text[self.statement_start]
        self.message_start = np.flatnonzero(np.concatenate(([True], self.message[1:] != self.message[:-1]))) if self.n else self.message

    def gradient(self, table: np.ndarray, out: np.ndarray, bias: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Loss and gradients summed over the messages."""
        if not self.n:
            return 0.0, np.zeros_like(table), np.zeros_like(out), np.zeros_like(bias)
        words = np.add.reduceat(table[self.feature], self.feature_start) / self.feature_count[:, None]
        mean = np.add.reduceat(words[self.word], self.statement_start) / self.statement_words[:, None]
        z = mean @ out + bias
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        miss = np.minimum(0, -np.logaddexp(0, z))  # log of 1 - p
        none = np.add.reduceat(miss, self.message_start)
        whose = self.message[self.message_start]
        y = self.labels[whose]
        hit = np.maximum(1 - np.exp(none), 1e-6)
        loss = float(-(y * np.log(hit) + (1 - y) * none).sum())
        pull = np.where(y > 0, -np.exp(none) / hit, 1.0)
        dz = pull[np.repeat(np.arange(len(whose)), np.diff(np.concatenate((self.message_start, [self.n]))))] * p
        d_mean = dz @ out.T / self.statement_words[:, None]
        d_words = np.add.reduceat(d_mean[self.statement][self.by_word], self.word_start) / self.feature_count[:, None]
        d_table = np.zeros_like(table)
        d_table[self.used] = np.add.reduceat(d_words[self.owner][self.by_feature], self.used_start)
        return loss, d_table, mean.T @ dz, dz.sum(0)


_SHARES: dict[str, Share] = {}


def fit(labelled: DataFrame, subjects: Sequence[str], text: str = "text", labels: str = "subjects", rounds: int = ROUNDS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each feature for each subject, and the subjects' biases, from rows of text and array of subjects."""
    spark = labelled.sparkSession
    scratch = Scratch(spark, "subjects")
    place = {s: k for k, s in enumerate(subjects)}
    rows = scratch.save("labelled", labelled.select(F.col(text).alias("text"), F.col(labels).alias("labels")).where("text is not null").repartition(SHARES, F.xxhash64("text")))
    run = uuid.uuid4().hex
    r = np.random.default_rng(seed)
    weights = [r.normal(0, 0.3, (1 << TABLE_BITS, DIMENSIONS)).astype(np.float32), r.normal(0, 0.3, (DIMENSIONS, len(subjects))).astype(np.float32), np.full(len(subjects), -2.0, np.float32)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def gradients(sent):
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts: list[str] = []
            wanted: list[list[str]] = []
            for b in batches:
                texts += b.column(0).to_pylist()
                wanted += b.column(1).to_pylist()
            if not texts:
                return
            key = f"{run} {hash((len(texts), texts[0], texts[-1]))}"
            if key not in _SHARES:  # a worker that served an earlier round still has its share prepared
                y = np.zeros((len(texts), len(place)), np.float32)
                for k, some in enumerate(wanted):
                    for s in some or []:
                        if s in place:
                            y[k, place[s]] = 1
                if len(_SHARES) > 2 * SHARES:
                    _SHARES.clear()
                _SHARES[key] = Share(texts, y)
            loss, *grads = _SHARES[key].gradient(*sent.value)
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([len(texts)]), *(pa.array([g.astype(np.float32).tobytes()], pa.binary()) for g in grads)], ["loss", "n", "g0", "g1", "g2"])

        return part

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, n, sums = 0.0, 0, None
        for b in batches:
            for k in range(b.num_rows):
                loss, n = loss + b.column(0)[k].as_py(), n + b.column(1)[k].as_py()
                grads = [np.frombuffer(b.column(2 + j)[k].as_py(), np.float32) for j in range(3)]
                sums = grads if sums is None else [a + g for a, g in zip(sums, grads, strict=True)]
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([n]), *(pa.array([g.tobytes()], pa.binary()) for g in sums)], ["loss", "n", "g0", "g1", "g2"])

    schema = "loss double, n long, g0 binary, g1 binary, g2 binary"
    for turn in range(1, rounds + 1):
        sent = spark.sparkContext.broadcast(weights)
        # the shares' gradients are summed in one task; there are SHARES of them, and the driver gets the sum
        parts = rows.mapInArrow(gradients(sent), schema).repartition(1).mapInArrow(together, schema).collect()
        sent.destroy()
        total = max(1, sum(x.n for x in parts))
        for k, w in enumerate(weights):
            g = sum((np.frombuffer(x[f"g{k}"], np.float32).reshape(w.shape) for x in parts), np.zeros_like(w)) / total
            g = g + (1e-6 * w if k < 2 else 0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            rate = 0.15 * min(1.0, 2.0 * (1 - turn / (rounds + 1)))
            weights[k] = (w - rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
    return weights[0] @ weights[1], weights[2]


def scores(texts: Sequence[str | None], features: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Highest probability of each subject over the statements of each text; 0 where a text has no words."""
    out = np.zeros((len(texts), len(bias)), np.float32)
    for a, b in chunks(texts, SCORE_CHARS):
        s = Statements(texts[a:b])
        if not len(s):
            continue
        _, first, word = np.unique(s.hash, return_index=True, return_inverse=True)
        feature, owner = s.features(first)
        begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        words = (np.add.reduceat(features[feature], begins) / np.bincount(owner)[:, None]).astype(np.float32)[word]
        start = np.flatnonzero(np.concatenate(([True], s.statement[1:] != s.statement[:-1])))
        size = np.diff(np.concatenate((start, [len(words)])))
        p = 1 / (1 + np.exp(-(np.add.reduceat(words, start) / size[:, None] + bias)))
        owner = s.text[start]
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        out[a + owner[begin]] = np.maximum.reduceat(p, begin)
    return out


def _key(text: Column) -> Column:
    """Hash of a text's letters; numbers, punctuation and which proper names it has after the first word don't count."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, r"(?<=[\p{L},] )\p{Lu}\p{Ll}+", "N")), r"\P{L}+", " ")))


def _examples(many: int = 8) -> Column:
    """Some texts of a group, drawn with partial aggregation by hashes."""
    return F.array_distinct(F.array(*[F.min_by("text", F.xxhash64(F.lit(k), "text")) for k in range(many)])).alias("texts")


def quiet_statements(sample: DataFrame, least: int = 5, share: float = 0.6) -> DataFrame:
    """``text`` of statements that the labelled messages repeat under changing subjects, so that they have none."""
    said = sample.select(F.explode(F.split("text", r"(?<=[.!?…])\s+|\n+")).alias("text"), "subjects").withColumn("key", _key(F.col("text")))
    often = said.groupBy("key").agg(F.count("*").alias("n"), _examples()).where(F.col("n") >= least)
    most = said.select("key", F.explode("subjects").alias("subject")).groupBy("key", "subject").agg(F.count("*").alias("n")).groupBy("key").agg(F.max("n").alias("most"))
    return often.join(most, "key").where(F.col("most") < share * F.col("n")).select(F.explode("texts").alias("text"))


def idle_messages(messages: DataFrame, sample: DataFrame, text: str, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``text`` of messages so frequent that some would be in the sample if they had a subject, while no label is of one.

    Counts cover all messages, and all labels are looked at. At most a third as many texts come out as the sample has rows.
    """
    size, total = sample.count(), messages.count()
    least = 3 * total / max(1, size)
    keyed = messages.select(F.col(text).alias("text"), _key(F.col(text)).alias("key")).where("text is not null")
    often = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("longest")).where(F.col("n") >= least).select("key", "longest")
    idle = Scratch(messages.sparkSession, "idle").save("idle", often.join(sample.select(_key(F.col("text")).alias("key")), "key", "left_anti"))
    longest = idle.agg(F.max("longest")).first()[0] or 0
    # longer texts have none of these keys, of which there are at most a third as many as rows in the sample
    near = messages.where(F.length(text) <= longest).select(*keys, F.col(text).alias("text"), _key(F.col(text)).alias("key")).join(F.broadcast(idle.select("key")), "key")
    labelled = near.select("key", *keys).join(labels.select(*keys).distinct(), list(keys), "left_semi").select("key").distinct()
    return near.groupBy("key").agg(_examples()).join(labelled, "key", "left_anti").select(F.explode("texts").alias("text"))


def assign_subjects(messages: DataFrame, labels: DataFrame, areas: DataFrame, keys: Sequence[str] = ("chat_id", "msg_id"), text: str = "text_clean", threshold: float = THRESHOLD, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """The key columns and ``subjects``, a sorted array of the subject areas of each message, empty if there are none.

    ``labels`` has a row (keys, ``subject``) for each subject of a sample of messages that have one; the model is fitted
    on at most ``most_labelled`` of them, and on repeated texts that evidently have none. All messages are scored, whole. A
    message has a subject if the model gives one of its statements a probability of at least ``threshold``. Null and
    wordless texts have none; labels with null keys or unknown subjects are passed over; without labels nothing has a
    subject. Repeated rows are scored alike.
    """
    subjects = sorted(r[0] for r in areas.select("subject").where("subject is not null").distinct().collect())
    spark = messages.sparkSession
    labels = labels.where(F.col("subject").isin(subjects))
    chosen = labels.groupBy(*keys).agg(F.collect_set("subject").alias("subjects")).withColumn("_rank", F.xxhash64(*keys)).orderBy("_rank", *keys).limit(most_labelled)
    scratch = Scratch(spark, "sample")
    # most_labelled rows at most
    sample = scratch.save("sample", messages.join(F.broadcast(chosen.drop("_rank")), list(keys)).select(F.col(text).alias("text"), "subjects").where("text is not null"))
    nothing = quiet_statements(sample).unionByName(idle_messages(messages, sample, text, labels, keys)).select("text", F.array().cast("array<string>").alias("subjects"))
    features, bias = fit(sample.unionByName(nothing), subjects)
    sent = spark.sparkContext.broadcast((features, bias, subjects))
    width = len(keys)
    schema = ", ".join([*(f"`{k}` {messages.schema[k].dataType.simpleString()}" for k in keys), "subjects array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, b, names = sent.value
        for batch in batches:
            has = scores(batch.column(width).to_pylist(), f, b) >= threshold
            at, which = np.nonzero(has)
            offsets = np.concatenate(([0], np.cumsum(has.sum(1))))
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(names, object)[which], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(width)), arrays], [*keys, "subjects"])

    return messages.select(*keys, text).mapInArrow(run, schema)


def composition(assigned: DataFrame) -> DataFrame:
    """``subject``, ``messages`` and ``share`` of all messages; null stands for messages without a subject."""
    total = assigned.agg(F.count("*").alias("total"))
    counts = assigned.select(F.explode_outer("subjects").alias("subject")).groupBy("subject").agg(F.count("*").alias("messages"))
    return counts.crossJoin(total).select("subject", "messages", (F.col("messages") / F.col("total")).alias("share"))
