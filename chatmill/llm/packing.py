"""Documents packed into containers of fixed capacity, planned on the histogram of their lengths.

The plan is made on the counts of each length (at most as many as the capacity), best fit from the longest down, so
its cost does not depend on the number of documents. Equal containers are planned together. Documents then take
the planned places by their rank among those of their length.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.plans.scratch import Scratch

#: Rows ranked within one task; hot lengths are split into as many blocks as that takes.
BLOCK_ROWS = 200_000


@lru_cache(maxsize=2)
def _encoder(file: str, pattern: str | None):
    import tiktoken

    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str, text: str, file: str, pattern: str | None = None) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of each row; nulls count as empty. ``file`` is a rank file readable by every task."""
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, pattern)
        for batch in batches:
            sizes = [len(encoder.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], [doc_id, "n_tokens"])

    return documents.select(doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, n_tokens long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Rows (length, first rank, places in each container, first container), sorted; the ranks of a length run on.

    Best fit in order of falling length, for all items of one length at once: they go to the open containers with the
    least sufficient space, as many to each as fit, then to new ones.
    """
    space: list[int] = []  # free spaces that occur, sorted
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # free space -> groups of equal containers: contents, how many
    closed: list[tuple[list[tuple[int, int]], int]] = []

    def put(free: int, contents: list[tuple[int, int]], many: int) -> None:
        if free == 0:
            closed.append((contents, many))
            return
        if free not in open_:
            insort(space, free)
            open_[free] = []
        open_[free].append((contents, many))

    for length in sorted((n for n in counts if n > 0), reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(space, length)
            if k < len(space):
                free = space[k]
                contents, many = open_[free].pop()
                if not open_[free]:
                    del open_[free]
                    space.pop(k)
            else:
                free, contents = capacity, []
                many = max(1, left // (capacity // length))
            each = min(free // length, left)
            full = min(many, left // each)
            if full < many and free < capacity:
                put(free, contents, many - full)
            put(free - each * length, [*contents, (length, each)], full)
            left -= each * full
    closed += [g for groups in open_.values() for g in groups]
    rank = dict.fromkeys(counts, 0)
    out, first = [], 0
    for contents, many in closed:
        for length, each in contents:
            out.append((length, rank[length], each, first))
            rank[length] += each * many
        first += many
    return sorted(out)


def pack(sizes: DataFrame, capacity: int = 4096, doc_id: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """A row for each document part: ``doc_id``, ``part_no``, ``part_begin``, ``part_end``, ``container_id``.

    A document is one part unless it alone exceeds the capacity; then it is cut into full containers and a rest, which is
    packed like a document. Begin and end count tokens. Null and empty sizes take no space: one part from 0 to 0 in
    container 0. Repeated ids are different documents; a null id is an id. Which of several documents of one length gets
    which place follows their ids. Containers are numbered from 0 without gaps.

    Ranks are found in blocks of a length, so no length, however common, meets in one task, and the driver sees
    counts only: at most ``capacity`` lengths, and one number for each block.
    """
    spark = sizes.sparkSession
    scratch = Scratch(spark, "packing")
    n = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    parts = sizes.select(F.col(doc_id).alias("id"), n.alias("n")).withColumn("parts", F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)).cast("int"))
    parts = scratch.save("sizes", parts)
    each = parts.select("id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "n").withColumn("length", F.least(F.col("n") - F.col("part").cast("long") * capacity, F.lit(capacity)).cast("int"))
    counts = {r.length: r.many for r in each.groupBy("length").agg(F.count("*").alias("many")).collect()}
    rows = plan(counts, capacity)
    places: dict[int, list[tuple[int, int, int]]] = {}
    for length, first, per, container in rows:
        places.setdefault(length, []).append((first, per, container))
    places[0] = [(0, max(1, counts.get(0, 1)), 0)]
    blocks = {length: -(-many // BLOCK_ROWS) for length, many in counts.items()}
    table = spark.createDataFrame([(length, blocks.get(length, 1)) for length in places], "length int, blocks int")
    # one row for each length, so at most capacity of them
    placed = each.join(F.broadcast(table), "length").withColumn("block", F.pmod(F.xxhash64("id", "part"), F.col("blocks")).cast("int"))
    placed = placed.select("length", "block", "id", "part", "n")
    starts: dict[tuple[int, int], int] = {}
    wide = [length for length, b in blocks.items() if b > 1]
    if wide:
        total: dict[int, int] = {}
        for r in placed.where(F.col("length").isin(wide)).groupBy("length", "block").agg(F.count("*").alias("many")).orderBy("length", "block").collect():
            starts[r.length, r.block] = total.get(r.length, 0)
            total[r.length] = total.get(r.length, 0) + r.many

    kind = sizes.schema[doc_id].dataType.simpleString()
    sent = spark.sparkContext.broadcast((places, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun = None, 0  # rows come sorted by length and block; the rank runs on over batches
        book, offsets = sent.value
        first: dict[int, np.ndarray] = {}
        for batch in batches:
            length, block = batch.column("length").to_numpy(), batch.column("block").to_numpy()
            container = np.zeros(len(length), np.int64)
            turn = np.flatnonzero(np.concatenate(([True], (length[1:] != length[:-1]) | (block[1:] != block[:-1]))))
            for a, b in zip(turn, [*turn[1:], len(length)], strict=True):
                key = (int(length[a]), int(block[a]))
                if key != now:
                    now, begun = key, offsets.get(key, 0)
                rank = begun + np.arange(b - a)
                begun += b - a
                if key[0] not in first:
                    first[key[0]] = np.array(book[key[0]], np.int64)
                some = first[key[0]]
                k = np.searchsorted(some[:, 0], rank, "right") - 1
                container[a:b] = some[k, 2] + (rank - some[k, 0]) // some[k, 1]
            part, n = batch.column("part").to_numpy().astype(np.int64), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(part.astype(np.int32)), pa.array(part * capacity), pa.array(np.minimum(n, (part + 1) * capacity)), pa.array(container)], [doc_id, "part_no", "part_begin", "part_end", "container_id"])

    ordered = placed.repartition("length", "block").sortWithinPartitions("length", "block", "id", "part")
    return ordered.mapInArrow(run, f"`{doc_id}` {kind}, part_no int, part_begin long, part_end long, container_id long")
