"""Stretches of text that appear verbatim in other documents, by sparse suffix trees split by prefixes.

A character is shared if it lies in a window of SPAN characters that another document holds too. Suffixes are taken
at anchors only: the positions whose KGRAM hashes least among WINDOW neighbours. The choice depends on the content
alone, so every shared window has an anchor at most WINDOW - 1 characters from its start, at the same place in both
documents, and from it the two agree on at least PREFIX characters. The anchored suffixes are therefore split by
their first PREFIX characters, and a group that stays within one document is dropped. A group's suffixes are then
split by their whole neighbourhood (WINDOW - 1 characters before, SPAN after): where two documents agree on all of it,
every window over the anchor is shared; this agreement is told by two independent hashes of 64 bits each. Only the rest, the
edges of shared stretches, has its characters compared: each group is cut at depth SPAN for each number of characters before
the anchor, and an inner node there that has leaves of two documents is a shared window. Groups too large for one task are
cut by the two hashes of their windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatmill.llm.codes import BASE, BASE2, INVERSE, INVERSE2, chunks, code_points, mix, powers, size_up
from chatmill.plans.scratch import Scratch

SPAN = 280
KGRAM = 24
#: Suffixes of one prefix compared in one task; a larger group is compared by its windows' hashes, spread over all tasks.
GROUP_ROWS = 50_000
#: Suffixes compared at once.
BATCH_ROWS = 10_000


class Layout:
    """Lengths that follow from the span: neighbours among which an anchor is chosen, and sure common prefix."""

    def __init__(self, span: int):
        self.span = span
        self.kgram = max(1, min(KGRAM, span // 4))
        self.window = max(1, min(200, span - self.kgram + 1 - span // 4))
        self.prefix = span - self.window + 1
        self.before = self.window - 1


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least value of every run of ``width`` values (the last of equals), by blocks of that width."""
    n = len(values)
    count = n - width + 1
    pad = -n % width
    v = np.concatenate((values, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    forward = np.minimum.accumulate(v, 1).ravel()
    backward = np.minimum.accumulate(v[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(backward[:count], forward[width - 1 : width - 1 + count])
    # consecutive runs with the same least value mostly share its position; look the position up once for each change
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    stop = np.concatenate((start[1:], [count])) + width - 1
    out = []
    for a, b, m in zip(start.tolist(), stop.tolist(), least[start].tolist(), strict=True):
        out.append(a + np.flatnonzero(values[a:b] == np.uint64(m)))
    return np.unique(np.concatenate(out))


class Hashes:
    """Hash of any stretch of a text, from running totals."""

    def __init__(self, raw: np.ndarray, base: int = BASE, inverse: int = INVERSE):
        n = size_up(len(raw) + 1)
        self.inverse = powers(n, inverse)
        with np.errstate(over="ignore"):
            self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(raw) * powers(n, base)[: len(raw)], dtype=np.uint64)))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def anchors(texts: list[str | None], lay: Layout) -> tuple[np.ndarray, ...]:
    """Text number, position, characters after it that count, prefix hash and two hashes of the neighbourhood of each anchor."""
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    raw = code_points("".join(t or "" for t in texts))
    ends = np.cumsum(sizes)
    none = np.zeros(0, np.int64)
    if len(raw) < lay.span:
        return none, none, none, none, none, none
    h = Hashes(raw)
    at = np.arange(len(raw) - lay.kgram + 1)
    least = _sliding_least(h.of(at, at + lay.kgram), lay.window)
    # a choice may look across the border of two texts; windows that lie in one text find their anchor nevertheless
    owner = np.searchsorted(ends, least, side="right")
    begin, end = ends[owner] - sizes[owner], ends[owner]
    fits = (least + lay.prefix <= end) & (end - begin >= lay.span)
    least, owner, begin, end = least[fits], owner[fits], begin[fits], end[fits]
    low, high = np.maximum(least - lay.before, begin), np.minimum(least + lay.span, end)
    before = (least - low).astype(np.uint64) << np.uint64(32)
    near, other = (mix(x.of(low, high) ^ before).view(np.int64) for x in (h, Hashes(raw, BASE2, INVERSE2)))
    return owner, least - begin, high - least, h.of(least, least + lay.prefix).view(np.int64), near, other


def _find_anchors(documents: DataFrame, lay: Layout, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                owner, at, tail, prefix, near, other = anchors(texts[a:b], lay)
                if len(owner):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner + a)), pa.array(at.astype(np.int32)), pa.array(tail.astype(np.int32)), pa.array(prefix), pa.array(near), pa.array(other)], ["id", "at", "tail", "prefix", "near", "other"])

    return documents.mapInArrow(run, f"id {kind}, at int, tail int, prefix long, near long, other long")


def _cut_edges(lay: Layout):
    """Compares the suffixes of whole groups, several groups at a time."""

    def spans(rows: pd.DataFrame) -> pd.DataFrame:
        n = len(rows)
        width = lay.before + lay.span
        p, inverse = powers(size_up(width + 1))[:width], powers(size_up(width + 1), INVERSE)
        pad, near = rows["pad"].to_numpy(np.int64), rows["near_text"].tolist()
        _, group = np.unique(rows["prefix"].to_numpy(), return_inverse=True)
        ids, doc = np.unique(rows["id"].to_numpy(), return_inverse=True)
        many = rows["many"].to_numpy(bool)
        key, ok = np.zeros((lay.window, n), np.uint64), np.zeros((lay.window, n), bool)
        letters = np.zeros((n, width), np.uint32)
        starts = lay.before - np.arange(lay.window)
        with np.errstate(over="ignore"):
            for a in range(0, n, 1000):
                part = slice(a, min(n, a + 1000))
                raw = letters[part]
                high = np.zeros(part.stop - a, np.int64)
                for k, t in enumerate(near[part]):
                    c = code_points(t)
                    high[k] = pad[a + k] + len(c)
                    raw[k, pad[a + k] : high[k]] = c
                total = np.zeros((part.stop - a, width + 1), np.uint64)
                np.cumsum(mix(raw) * p, axis=1, out=total[:, 1:])
                key[:, part] = mix(((total[:, starts + lay.span] - total[:, starts]) * inverse[starts]).T) + mix(group[part].astype(np.uint64))
                ok[:, part] = (pad[part][None, :] <= starts[:, None]) & (high[None, :] >= starts[:, None] + lay.span)
        least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for before in range(lay.window):
            who = np.flatnonzero(ok[before])
            if len(who) == 0:
                continue
            order = np.argsort(key[before, who], kind="stable")
            who = who[order]
            sorted_key = key[before, who]
            start = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
            d = doc[who]
            # a neighbourhood that several documents have stands here for all of them
            shared = (np.minimum.reduceat(d, start) != np.maximum.reduceat(d, start)) | np.maximum.reduceat(many[who], start)
            # equal hashes are confirmed on the characters, against the first of each run
            size = np.diff(np.concatenate((start, [len(who)])))
            some, rep = np.repeat(shared, size), np.repeat(who[start], size)
            hit, rep = who[some], rep[some]
            window = slice(starts[before], starts[before] + lay.span)
            same = np.concatenate([(letters[hit[k : k + 4096], window] == letters[rep[k : k + 4096], window]).all(1) for k in range(0, len(hit), 4096)] or [np.zeros(0, bool)])
            if not same.all():
                hit = _exactly(who, letters[:, window], group, doc, many)
            most[hit] = before
            least[hit] = np.where(least[hit] < 0, before, least[hit])
        keep = most >= 0
        at = rows["at"].to_numpy(np.int64)[keep]
        return pd.DataFrame({"id": rows["id"].to_numpy()[keep], "begin": at - most[keep], "end": at - least[keep] + lay.span})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= BATCH_ROWS:
                rows = pd.concat(held, ignore_index=True)
                last = rows["prefix"].iloc[-1]  # rows come sorted by prefix; the last group may go on
                done = rows[rows["prefix"] != last]
                if len(done):
                    yield spans(done.reset_index(drop=True))
                held = [rows[rows["prefix"] == last]]
                count = len(held[0])
        if count:
            yield spans(pd.concat(held, ignore_index=True))

    return run


def _exactly(who: np.ndarray, letters: np.ndarray, group: np.ndarray, doc: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The rows whose window another document has, by the characters themselves; for windows with equal hashes that differ."""
    held: dict[tuple[int, bytes], list[int]] = {}
    for k in who.tolist():
        held.setdefault((int(group[k]), letters[k].tobytes()), []).append(k)
    return np.array([k for rows in held.values() if len({int(doc[k]) for k in rows}) > 1 or many[rows].any() for k in rows], np.int64)


def _read_edges(lay: Layout, id_kind: str):
    """Cuts the neighbourhoods of a document's anchors out of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, wanted = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            row, at, prefix, many, pad, near = [], [], [], [], [], []
            for k, (t, some) in enumerate(zip(texts, wanted, strict=True)):
                for x in some:
                    p = x["at"]
                    row.append(k)
                    at.append(p)
                    prefix.append(x["prefix"])
                    many.append(x["many"])
                    pad.append(max(0, lay.before - p))
                    near.append(t[max(0, p - lay.before) : p + lay.span])
                    if len(row) >= 20_000:
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(at, pa.int32()), pa.array(prefix, pa.int64()), pa.array(many, pa.bool_()), pa.array(pad, pa.int32()), pa.array(near)], ["id", "at", "prefix", "many", "pad", "near_text"])
                        row, at, prefix, many, pad, near = [], [], [], [], [], []
            if row:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(at, pa.int32()), pa.array(prefix, pa.int64()), pa.array(many, pa.bool_()), pa.array(pad, pa.int32()), pa.array(near)], ["id", "at", "prefix", "many", "pad", "near_text"])

    return run, f"id {id_kind}, at int, prefix long, many boolean, pad int, near_text string"


def _window_hashes(lay: Layout):
    """The hash of every window over an anchor, for groups too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, pads = batch.column("near_text").to_pylist(), batch.column("pad").to_pylist()
            before = np.arange(lay.window)
            rows, befores, keys, others, held = [], [], [], [], 0

            def made() -> pa.RecordBatch:
                same = pa.array(np.concatenate(rows))  # noqa: B023
                own = [batch.column(c).take(same) for c in ("id", "at", "prefix", "many")]  # noqa: B023
                return pa.RecordBatch.from_arrays([*own, pa.array(np.concatenate(befores).astype(np.int32)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(others))], ["id", "at", "prefix", "many", "before", "key", "other"])  # noqa: B023

            for k, (t, pad) in enumerate(zip(near, pads, strict=True)):
                start = lay.before - before - pad
                ok = (start >= 0) & (start + lay.span <= len(t))
                if ok.any():
                    rows.append(np.full(int(ok.sum()), k))
                    befores.append(before[ok])
                    raw = code_points(t)
                    keys.append(Hashes(raw).of(start[ok], start[ok] + lay.span).view(np.int64))
                    others.append(Hashes(raw, BASE2, INVERSE2).of(start[ok], start[ok] + lay.span).view(np.int64))
                    held += len(keys[-1])
                if held > 50_000:
                    yield made()
                    rows, befores, keys, others, held = [], [], [], [], 0
            if held:
                yield made()

    return run


def shared_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """A row (``doc_id``, ``span_begin``, ``span_end``) for each maximal run of characters shared with another id.

    A character is shared if it lies in ``span`` characters that occur, exactly, in the text of another id. Texts
    shorter than that, null or empty share nothing; rows with a null id are left out. Repeats within one document, or
    within rows of the same id, don't count; rows that repeat an id must have the same text. Positions count code
    points. Further columns are ignored.

    Shuffled are two hashes for about every hundredth position; then, for documents with an edge, their text once and
    the neighbourhoods of edges. Hot groups are pre-aggregated; one that outgrows a task is compared by window hashes.
    """
    spark = documents.sparkSession
    lay = Layout(span)
    scratch = Scratch(spark, "spans")
    kind = documents.schema[doc_id].dataType.simpleString()
    docs = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(f"id is not null and length(text) >= {span}")
    found = scratch.save("anchors", _find_anchors(docs, lay, kind))
    near = found.groupBy("prefix", "near", "other").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min(F.struct("id", "at")).alias("one"))
    group = near.groupBy("prefix").agg(F.min("low").alias("glow"), F.max("high").alias("ghigh"), F.count("*").alias("kinds"), F.count(F.when(F.col("low") == F.col("high"), 1)).alias("alone"))
    group = scratch.save("groups", group.where("glow < ghigh"))
    many = F.col("low") < F.col("high")
    edge = (F.col("kinds") > 1) & (F.col("alone") > 0)
    classes = scratch.save("classes", near.join(group, "prefix").select("prefix", "near", "other", many.alias("many"), edge.alias("edge"), "one", "kinds").where("many or edge"))
    # all anchors of a neighbourhood are wanted where several documents have it, and one of them stands for it at edges
    rows = found.join(classes, ["prefix", "near", "other"]).select("id", "at", "tail", "prefix", "many", "kinds", (F.col("edge") & (~F.col("many") | ((F.col("id") == F.col("one.id")) & (F.col("at") == F.col("one.at"))))).alias("edge"))
    rows = scratch.save("rows", rows)
    scratch.drop("anchors", "groups", "classes")
    inner = rows.where("many").select("id", F.greatest(F.col("at") - lay.before, F.lit(0)).alias("begin"), (F.col("at") + F.col("tail")).alias("end"))

    wanted = rows.where("edge").groupBy("id").agg(F.collect_list(F.struct("at", "prefix", "many", (F.col("kinds") > GROUP_ROWS).alias("hot"))).alias("wanted"))
    cut, schema = _read_edges(lay, kind)
    joined = docs.join(wanted, "id")
    cold = joined.select("id", "text", F.filter("wanted", lambda x: ~x["hot"]).alias("wanted")).where("size(wanted) > 0")
    edges = cold.mapInArrow(cut, schema).repartition("prefix").sortWithinPartitions("prefix").mapInPandas(_cut_edges(lay), f"id {kind}, begin int, end int")
    runs = inner.unionByName(edges)
    if not rows.where((F.col("kinds") > GROUP_ROWS) & F.col("edge")).isEmpty():
        hot = joined.select("id", "text", F.filter("wanted", lambda x: x["hot"]).alias("wanted")).where("size(wanted) > 0")
        keys = scratch.save("keys", hot.mapInArrow(cut, schema).mapInArrow(_window_hashes(lay), f"id {kind}, at int, prefix long, many boolean, before int, key long, other long"))
        good = keys.groupBy("prefix", "before", "key", "other").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max("many").alias("m")).where("a < b or m").select("prefix", "before", "key", "other")
        hits = keys.join(good, ["prefix", "before", "key", "other"]).groupBy("id", "at").agg(F.max("before").alias("most"), F.min("before").alias("least"))
        runs = runs.unionByName(hits.select("id", (F.col("at") - F.col("most")).alias("begin"), (F.col("at") - F.col("least") + span).alias("end")))
    # runs that touch are one
    along = Window.partitionBy("id").orderBy("begin", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("begin") <= F.col("reach"), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    merged = runs.withColumn("reach", reach).withColumn("island", island).groupBy("id", "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return merged.select(F.col("id").alias(doc_id), F.col("begin").cast("long").alias("span_begin"), F.col("end").cast("long").alias("span_end"))


def shared_fraction(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """A row for each document: characters, shared characters (0 where none) and their fraction; ids count once."""
    spans = shared_spans(documents, doc_id, text, span).groupBy(doc_id).agg(F.sum(F.col("span_end") - F.col("span_begin")).alias("shared_chars"), F.count("*").alias("shared_runs"))
    sizes = documents.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(F.coalesce(F.length(text), F.lit(0))).cast("long").alias("chars"))
    shared = F.coalesce("shared_chars", F.lit(0))
    return sizes.join(spans, doc_id, "left").select(doc_id, "chars", shared.alias("shared_chars"), F.coalesce("shared_runs", F.lit(0)).alias("shared_runs"), F.when(F.col("chars") > 0, shared / F.col("chars")).otherwise(0.0).alias("shared_fraction"))
