"""At-least-once delivery: one copy of each message, without shuffling payloads.

Only identifier, delivery order and the position of a row in its file are shuffled. From them come the losing
rows, which are turned into deletion vectors: one bitmap for each run of 32,768 rows of a file. The payload is then
read once more, and each row looks up its bit in the vector of its file.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatmill.plans.scratch import Scratch

#: Rows covered by one bitmap of bitmap_construct_agg.
BUCKET = 32_768
#: Bytes of a row of the vector table: two bitmaps of 4 KB, file and bucket.
VECTOR_BYTES = 2 * BUCKET // 8 + 32
#: Bytes of vectors that lie together where they aren't broadcast, and files whose vectors a worker holds.
SHELF_BYTES = 16 << 20
HELD_FILES = 4
DEAD, KEPT = 1, 2


def _with_position(frame: DataFrame) -> list[Column]:
    return [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def _narrow(spark: SparkSession, path: str | Sequence[str], key: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """Identifier, order and position of each row that has an identifier."""
    source = spark.read.parquet(*([path] if isinstance(path, str) else path))
    rows = source.select(*[(F.col(k) if isinstance(k, str) else k).alias(f"_k{n}") for n, k in enumerate(key)], *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order)], *_with_position(source))
    known = F.lit(True)
    for n in range(len(key)):
        known = known & F.col(f"_k{n}").isNotNull()
    return rows.where(known)


def _winners(narrow: DataFrame, keys: int, orders: int) -> DataFrame:
    rank = F.struct(*[x for n in range(orders) for x in (F.col(f"_o{n}").isNull().alias(f"_n{n}"), F.col(f"_o{n}"))], F.col("_file"), F.col("_row"))
    return narrow.groupBy(*[f"_k{n}" for n in range(keys)]).agg(F.min(rank).alias("_w"), F.count("*").alias("_copies"))


def delivery_winners(spark: SparkSession, path: str | Sequence[str], key: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """Identifier, position of the copy to keep and number of copies; rows with a null in the key are left out.

    The first delivery wins: smallest ``order`` (nulls last), then file and row.
    """
    return _winners(_narrow(spark, path, key, order), len(key), len(order))


def deletion_vectors(spark: SparkSession, path: str | Sequence[str], key: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """A row for each run of 32,768 rows of a file that holds a repeated message: bitmaps ``dead`` and ``kept``.

    ``kept`` marks the remaining copy of a message that came more than once. A key that has to be computed is so once.
    """
    keys = [f"_k{n}" for n in range(len(key))]
    narrow = _narrow(spark, path, key, order)
    if not all(isinstance(k, str) for k in key):
        narrow = Scratch(spark, "narrow").save("narrow", narrow)
    repeated = _winners(narrow, len(key), len(order)).where("_copies > 1").select(*keys, F.col("_w._file").alias("_wf"), F.col("_w._row").alias("_wr"))
    marks = narrow.select(*keys, "_file", "_row").join(repeated, keys).select(
        "_file",
        F.bitmap_bucket_number(F.col("_row") + 1).alias("_bucket"),
        F.bitmap_bit_position(F.col("_row") + 1).alias("_bit"),
        ((F.col("_file") == F.col("_wf")) & (F.col("_row") == F.col("_wr"))).alias("_wins"),
    )
    # bitmap_construct_agg passes over nulls and gives an empty bitmap where there is nothing else
    return marks.groupBy("_file", "_bucket").agg(
        F.bitmap_construct_agg(F.when(~F.col("_wins"), F.col("_bit"))).alias("dead"),
        F.bitmap_construct_agg(F.when(F.col("_wins"), F.col("_bit"))).alias("kept"),
    )


def _bit(bitmap: str) -> Column:
    return F.expr(f"getbit(cast(conv(hex(substring({bitmap}, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int), cast(_bit % 8 as int)) = 1")


def deduplicate_deliveries(
    spark: SparkSession,
    path: str | Sequence[str],
    key: Sequence[str | Column] = ("chat_id", "msg_id"),
    order: Sequence[str] = ("batch_id", "ingested_at"),
    columns: Sequence[str] | None = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Exactly one row of each message of a Parquet table, plus ``redelivered``: whether there were further copies.

    The copy of the first delivery is kept, by ``order`` with nulls last, ties by file and row. A row with a null in
    its key has no identity and is kept. Empty tables give no rows; all payload columns pass through, whatever their
    names, except ones called like the internal columns _file, _row, _bucket, _bit and redelivered.

    The vectors hold two bits a row of the buckets with copies. While they fit ``broadcast_bytes`` the scan of the payload
    takes them by broadcast. Beyond it they lie in the shared folder, sorted by file on shelves of bounded size, and each task
    reads those of the files it scans; file and row numbers alone go through Python, the payload stays where it is.
    """
    scratch = Scratch(spark, "redelivery")
    vectors = scratch.save("vectors", deletion_vectors(spark, path, key, order))
    source = spark.read.parquet(*([path] if isinstance(path, str) else path))
    # no column is read for it
    files = source.select(F.col("_metadata.file_path").alias("f")).distinct()
    if files.agg((F.count("f") > F.countDistinct(F.xxhash64("f"))).alias("clash")).first().clash:
        raise ValueError("two files of the table share a hash")
    size = vectors.count() * VECTOR_BYTES
    wanted = list(columns or source.columns)
    rows = source.select(*wanted, *_with_position(source))
    if size <= broadcast_bytes:
        rows = rows.withColumns({"_bucket": F.bitmap_bucket_number(F.col("_row") + 1), "_bit": F.bitmap_bit_position(F.col("_row") + 1)})
        marked = rows.join(F.broadcast(vectors), ["_file", "_bucket"], "left")
        return marked.where(F.col("dead").isNull() | ~_bit("dead")).select(*wanted, F.coalesce(_bit("kept"), F.lit(False)).alias("redelivered"))
    shelves = -(-size // SHELF_BYTES)
    by_shelf = vectors.withColumn("_shelf", F.pmod("_file", F.lit(shelves)).cast("int")).repartition("_shelf").sortWithinPartitions("_shelf", "_file", "_bucket")
    by_shelf.write.partitionBy("_shelf").option("parquet.block.size", 4 << 20).option("compression", "zstd").parquet(scratch.path("shelves"))
    state = F.pandas_udf(_states(scratch.path("shelves"), shelves), "int")
    marked = rows.withColumn("_state", state("_file", "_row"))
    return marked.where(F.col("_state") != DEAD).select(*wanted, (F.col("_state") == KEPT).alias("redelivered"))


def _states(folder: str, shelves: int):
    """Looks rows up in the vectors of their files, which are read once for each file and worker."""
    held: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}

    def load(file: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)
        shelf = f"{root}/_shelf={file % shelves}"
        if system.get_file_info(shelf).type == fs.FileType.NotFound:
            return {}
        found = pq.read_table(shelf, filesystem=system, filters=[("_file", "=", file)], columns=["_bucket", "dead", "kept"], partitioning=None)
        bits = lambda c: [np.frombuffer(b, np.uint8) for b in found.column(c).to_pylist()]
        return {b: (d, k) for b, d, k in zip(found.column("_bucket").to_pylist(), bits("dead"), bits("kept"), strict=True)}

    def state(files: pd.Series, rows: pd.Series) -> pd.Series:
        file, row = files.to_numpy(), rows.to_numpy()
        out = np.zeros(len(row), np.int32)
        for f in np.unique(file).tolist():
            if f not in held:
                while len(held) >= HELD_FILES:
                    held.pop(next(iter(held)))
                held[f] = load(f)
            mine = np.flatnonzero(file == f)
            bucket, bit = row[mine] // BUCKET + 1, row[mine] % BUCKET
            for b in np.unique(bucket).tolist():
                if b in held[f]:
                    some = bucket == b
                    for value, bitmap in zip((DEAD, KEPT), held[f][b], strict=True):
                        hit = bitmap[bit[some] >> 3] >> (bit[some] & 7) & 1
                        out[mine[some][hit == 1]] = value
        return pd.Series(out)

    return state
