"""Raw chat exports and line files to frames."""

from __future__ import annotations

import codecs
import glob
import json
import os
import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FIELDS = ("id", "type", "action", "date_unixtime", "date", "datetime", "timestamp", "from", "actor", "from_id", "actor_id", "user_id", "sender", "text", "photo", "file", "media_type", "voice_message", "video_file", "reply_to_message_id", "forwarded_from", "title")
_VISIBLE = re.compile(r"[^ \t\r\n]")


class ExportError(Exception):
    """No source could be read."""


def find_exports(folder: str, pattern: str = "ChatExport_*", spark: SparkSession | None = None) -> list[str]:
    """Export folders below a folder, sorted; with a session in any file system that Spark reads."""
    if spark is None:
        return sorted(glob.glob(os.path.join(folder, pattern)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    return sorted(s.getPath().toString() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or ())


def _source_file(spark: SparkSession, folder: str, file: str) -> str | None:
    """Full path of the file of a source, if there is one."""
    jvm = spark._jvm
    for name in (folder, f"{folder.rstrip('/')}/{file}"):
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(path) and system.getFileStatus(path).isFile():
            return system.makeQualified(path).toString()
    return None


def missing_sources(spark: SparkSession, folders: Sequence[str], file: str = "result.json") -> list[str]:
    """The sources that ``read_exports`` passes over, as they can't be found."""
    return [f for f in folders if _source_file(spark, f, file) is None]


def _own(name: str) -> Column:
    return F.col("m").getItem(name)


def _some(*names: str) -> Column:
    """The first of the fields that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_own(n), F.lit("")) for n in names])


def raw_text(text: Column) -> Column:
    """Text of a message: a string as it is, trimmed; of a list its strings, numbers and the texts of its objects joined."""
    parts = F.from_json(text, "array<string>")
    joined = F.array_join(F.transform(parts, lambda p: F.when(p.startswith("{"), F.coalesce(F.get_json_object(p, "$.text"), F.lit(""))).otherwise(p)), "")
    return F.when(text.isNull(), "").when(F.ltrim(text).startswith("["), F.coalesce(joined, F.trim(text))).otherwise(F.trim(text))


def parsed_time() -> Column:
    """Seconds since 1970: unix time, numeric date, ISO date, three other formats, else 0."""
    seconds = lambda n: _own(n).try_cast("double").cast("long")
    iso = lambda n: F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(_own(n), "Z$", "+00:00")))
    formats = ("dd.MM.yyyy HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
    names = ("date", "datetime", "timestamp")
    tries = [seconds("date_unixtime"), *[seconds(n) for n in names], *[iso(n) for n in names], *[F.unix_timestamp(F.try_to_timestamp(_own(n), F.lit(f))) for n in names for f in formats]]
    return F.coalesce(*tries, F.lit(0).cast("long"))


#: Bytes read at once, and characters of messages handed on at once.
BLOCK_BYTES = 4 << 20


class _Json:
    """Values of a JSON text one after another, from a stream of which only what is being read is held."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.text, self.at, self.ended, self.want = stream, "", 0, False, BLOCK_BYTES
        self.decode = codecs.getincrementaldecoder("utf-8-sig")(errors="replace")
        self.parse = json.JSONDecoder(strict=False).raw_decode

    def more(self) -> None:
        block = self.stream.read(self.want)
        self.ended = not block
        self.text, self.at = self.text[self.at :] + self.decode.decode(block, self.ended), 0

    def peek(self) -> str:
        """The next character that is no white space, "" at the end."""
        while True:
            found = _VISIBLE.search(self.text, self.at)
            if found:
                self.at = found.start()
                return self.text[self.at]
            self.at = len(self.text)
            if self.ended:
                return ""
            self.more()

    def take(self, wanted: str) -> str:
        c = self.peek()
        if not c or c not in wanted:
            raise ValueError(f"{wanted!r} expected, not {c!r}")
        self.at += 1
        return c

    def value(self) -> tuple[object, str]:
        """The next value, and how it is written."""
        self.peek()
        self.want = BLOCK_BYTES
        while True:
            try:
                found, end = self.parse(self.text, self.at)
                if end < len(self.text) or self.ended:
                    break
            except json.JSONDecodeError:
                if self.ended:
                    raise
            # of a long value ever more is read, so that it isn't begun too often
            self.more()
            self.want *= 2
        written, self.at = self.text[self.at : end], end
        return found, written

    def elements(self) -> Iterator[tuple[object, str]]:
        self.take("[")
        if self.peek() == "]":
            return
        while True:
            yield self.value()
            if self.take(",]") == "]":
                return

    def messages(self) -> Iterator[tuple[object, str]]:
        """The elements of a list, or of the list "messages" of an object."""
        if self.peek() == "[":
            yield from self.elements()
            return
        self.take("{")
        while self.peek() not in ("}", ""):
            name, _ = self.value()
            self.take(":")
            if name == "messages":
                if self.peek() == "[":
                    yield from self.elements()
                return
            self.value()
            if self.take(",}") == "}":
                return


def _open(path: str) -> BinaryIO:
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", path))
    return system.open_input_stream(name)


def _raw_messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["source", "pos", "raw"]

    def made(rows: list[tuple[int, int, str | None]]) -> pa.RecordBatch:
        k, pos, raw = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(pos, pa.int64()), pa.array(raw, pa.string())], names)

    for batch in batches:
        for k, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows: list[tuple[int, int, str | None]] = []
            size = 0
            try:
                with _open(path) as stream:
                    for pos, (value, written) in enumerate(_Json(stream).messages()):
                        if isinstance(value, dict):
                            rows.append((k, pos, written))
                            size += len(written)
                        if size > BLOCK_BYTES:
                            yield made(rows)
                            rows, size = [], 0
            except (OSError, ValueError, RecursionError):
                rows.append((k, -1, None))
            if rows:
                yield made(rows)


def _listed(spark: SparkSession, folders: Sequence[str], file: str) -> DataFrame:
    found = [(k, path) for k, f in enumerate(folders, start=1) if (path := _source_file(spark, f, file)) is not None]
    if not found:
        raise ExportError(f"none of {len(folders)} sources can be read")
    files = spark.createDataFrame(found, "source int, path string").repartition(len(found), "source")
    return files.mapInArrow(_raw_messages, "source int, pos long, raw string")


def broken_sources(spark: SparkSession, folders: Sequence[str], file: str = "result.json") -> list[str]:
    """The sources whose text ends, or breaks, before its list of messages does; their readable messages come through."""
    return [folders[r.source - 1] for r in _listed(spark, folders, file).where("raw is null").select("source").distinct().orderBy("source").collect()]


def read_exports(spark: SparkSession, folders: Sequence[str], file: str = "result.json") -> DataFrame:
    """Normalized messages of several exports: a file, or a folder that holds ``file``, with a list of messages or an object.

    Sources get the names community_node_01... and the chat ids 1001... by their place in ``folders``, so that names of
    chats don't come through. Missing sources are passed over; if all are missing this raises. Of a source that breaks off
    the messages before the break are read. Entries that aren't objects are skipped. An id that is missing, unreadable or 0
    is replaced by the place in the file. All times are UTC. Each source is read by one task as a stream of messages, of
    which it holds a block.
    """
    rows = _listed(spark, folders, file).where("raw is not null").select("source", "pos", F.from_json("raw", f"struct<{', '.join(f'`{f}`: string' for f in _FIELDS)}>").alias("m"))
    author = F.coalesce(_some("from", "actor", "from_id", "actor_id", "sender"), F.lit("Anonymous"))
    service = F.coalesce(_own("type") == "service", F.lit(False)) | _own("action").isNotNull()
    text = raw_text(_own("text"))
    title = F.nullif(_own("title"), F.lit(""))
    media = F.when(_some("media_type").isNotNull(), _own("media_type")).when(_some("photo").isNotNull(), "photo").when(_some("voice_message").isNotNull(), "voice").when(_some("video_file").isNotNull(), "video").when(_some("file").isNotNull(), "document")
    return rows.select(
        F.coalesce(F.nullif(_own("id").try_cast("long"), F.lit(0)), F.col("pos") + 1).cast("long").alias("msg_id"),
        (F.col("source") + 1000).cast("long").alias("chat_id"),
        F.format_string("community_node_%02d", "source").alias("chat_name"),
        F.timestamp_seconds(parsed_time()).alias("timestamp"),
        parsed_time().alias("unixtime"),
        author.alias("author_raw"),
        F.coalesce(_some("from_id", "actor_id", "user_id"), author).alias("author_id_raw"),
        F.when(service & title.isNotNull(), F.replace(text, title, F.lit("[COMMUNITY_NAME_REDACTED]"))).otherwise(text).alias("text_raw"),
        _own("reply_to_message_id").try_cast("long").alias("reply_to_id"),
        media.isNotNull().alias("has_media"),
        media.alias("media_type"),
        service.alias("is_service"),
        F.nullif(_own("forwarded_from"), F.lit("")).alias("forwarded_from"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` and ``state`` (valid, blank, corrupt) of each line of a JSONL file."""
    return lines_state(spark.read.text(path).withColumnRenamed("value", "line"), "line")


def lines_state(rows: DataFrame, line: str) -> DataFrame:
    return rows.withColumn("state", F.when(F.trim(F.coalesce(line, F.lit(""))) == "", "blank").when(F.json_object_keys(line).isNull(), "corrupt").otherwise("valid"))


def head(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in an order: a preview is a limit by nature."""
    return rows.orderBy(*order).limit(n)


def tail_holdout(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in an order, in that order reversed."""
    return rows.orderBy(*[F.desc(c) for c in order]).limit(n)


def parquet_footers(paths: Sequence[str]) -> list[tuple[str, int, list[str]]]:
    """Path, rows and columns of files, from their footers alone."""
    import pyarrow.parquet as pq

    out = []
    for p in paths:
        f = pq.ParquetFile(p)
        out.append((p, f.metadata.num_rows, f.schema_arrow.names))
    return out
