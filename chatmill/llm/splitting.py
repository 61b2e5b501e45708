"""Items over a size limit cut into overlapping pieces at natural boundaries, by recursive bisection.

A stretch that is too long is cut at the strongest boundary near its midpoint, and both halves are treated alike
until each leaves room for the overlap. Then every piece but the first is given the end of the one before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boundaries from the strongest to the weakest; a cut goes to the end of a match.
TEXT_BOUNDARIES = (
    re.compile(r"\n[ \t]*\n+(?=\S)|\n```[^\n`]*\n(?=\n|\S)|\n(?=```)|\n(?=#{1,6} )"),
    re.compile(r"\n+"),
    re.compile(r"[.!?…]+[\"'»”)\]]*\s+"),
    re.compile(r"[;:,—–]\s+"),
    re.compile(r"\s+"),
    re.compile(r"[^\w\s](?=\w)"),
)
#: Inside a line of JSON the breaks of its strings are escaped.
JSON_BOUNDARIES = (
    re.compile(r"\}\s*,\s*(?=\{)|\]\s*,\s*(?=\")"),
    re.compile(r"\"\s*,\s*(?=\")|(?<!\\)(?:\\\\)*\\n(?:\\n)+"),
    re.compile(r"(?<!\\)(?:\\\\)*\\n"),
    re.compile(r"[.!?…]+[\"'»”)\]]*\s+|\\u2026\s+"),
    re.compile(r"[;:,—–]\s+"),
    re.compile(r"\s+"),
)
#: What must not be torn apart: an escape, a pair of escaped surrogates, a character with its marks or joiners.
_ESCAPE = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\.")
_CLINGS = re.compile("[̀-ͯ҃-҉︀-️‍⃐-⃿\U0001f3fb-\U0001f3ff]")


def _safe(text: str, cut: int, low: int, escapes: bool) -> int:
    """The nearest place at or before ``cut``, after ``low``, that tears nothing apart; ``cut`` where there is none."""
    at = cut
    if escapes:
        start = text.rfind("\\", max(low, at - 12), at)
        if start >= 0:
            while start > low and text[start - 1] == "\\":
                start -= 1
            # escapes that precede: walk over them from a place that can't lie inside one
            k = start
            while k < at:
                m = _ESCAPE.match(text, k)
                if m and m.end() > at:
                    at = k
                    break
                k = m.end() if m else k + 1
    while at > low + 1 and at < len(text) and (_CLINGS.match(text, at) or text[at - 1] == "‍"):
        at -= 1
    return at if at > low else cut


def cuts(text: str, size: int, boundaries: tuple[re.Pattern[str], ...], escapes: bool = False) -> list[int]:
    """Where the pieces end, so that none is longer than ``size``."""
    places = [[m.end() for m in b.finditer(text)] for b in boundaries]
    from bisect import bisect_left, bisect_right

    out: list[int] = []
    todo = [(0, len(text))]
    while todo:
        begin, end = todo.pop()
        n = end - begin
        if n <= size:
            out.append(end)
            continue
        middle = begin + n // 2
        # near the midpoint: a quarter of the stretch to either side, but no side may get shorter than it must
        reach = max(1, n // 4)
        low, high = max(begin + 1, middle - reach), min(end - 1, middle + reach)
        cut = 0
        for ends in places:
            a, b = bisect_left(ends, low), bisect_right(ends, high)
            if a < b:
                k = bisect_left(ends, middle, a, b)
                near = [ends[j] for j in (k - 1, k) if a <= j < b]
                cut = min(near, key=lambda x: abs(x - middle))
                break
        if not cut:
            cut = middle
        cut = _safe(text, cut, begin, escapes)
        todo.append((cut, end))
        todo.append((begin, cut))
    return out


def pieces(text: str, limit: int, overlap: int, boundaries: tuple[re.Pattern[str], ...] = TEXT_BOUNDARIES, escapes: bool = False) -> list[tuple[int, int]]:
    """Begin and end of each piece; each after the first begins ``overlap`` characters before the end of its predecessor."""
    if len(text) <= limit:
        return [(0, len(text))]
    out, begin = [], 0
    for end in cuts(text, limit - overlap, boundaries, escapes):
        out.append((max(0, begin - overlap), end))
        begin = end
    return out


def split_items(rows: DataFrame, ids: list[str], text: str, limit: int, overlap: int = 100, kind: str = "text") -> DataFrame:
    """A row for each piece: the ids, ``piece_no`` from 0, ``piece_begin``, ``piece_end``, ``piece``, ``n_pieces``.

    No piece is longer than ``limit`` code points. Each piece after the first starts with the last ``overlap``
    characters of the one before, so dropping that many gives the item back. Where the pieces before are shorter than the
    overlap, it is what there is. An item within the limit, also an empty one, is one piece; a null item gives no row.
    Items are judged one by one, so repeated rows are cut alike, and ids may be null. ``kind`` is "text" or "json"; in
    the latter escapes stay whole. Only the items over the limit go through Python; nothing is shuffled.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be under half the limit")
    boundaries, escapes = (JSON_BOUNDARIES, True) if kind == "json" else (TEXT_BOUNDARIES, False)
    narrow = rows.select(*ids, F.col(text).alias("piece")).where("piece is not null")
    short = narrow.where(F.length("piece") <= limit).select(*ids, F.lit(0).alias("piece_no"), F.lit(0).alias("piece_begin"), F.length("piece").alias("piece_end"), "piece", F.lit(1).alias("n_pieces"))
    id_schema = ", ".join(f"`{i}` {rows.schema[i].dataType.simpleString()}" for i in ids)
    width = len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(width).to_pylist()
            row, number, begin, end, cut, of = [], [], [], [], [], []

            def made() -> pa.RecordBatch:
                columns = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(width)]  # noqa: B023
                return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int32()) for x in (number, begin, end)), pa.array(cut), pa.array(of, pa.int32())], [*ids, "piece_no", "piece_begin", "piece_end", "piece", "n_pieces"])  # noqa: B023

            for k, t in enumerate(texts):
                some = pieces(t, limit, overlap, boundaries, escapes)
                for j, (a, b) in enumerate(some):
                    row.append(k)
                    number.append(j)
                    begin.append(a)
                    end.append(b)
                    cut.append(t[a:b])
                    of.append(len(some))
                if len(row) > 5000:
                    yield made()
                    row, number, begin, end, cut, of = [], [], [], [], [], []
            if row:
                yield made()

    long = narrow.where(F.length("piece") > limit).mapInArrow(run, f"{id_schema}, piece_no int, piece_begin int, piece_end int, piece string, n_pieces int")
    return short.unionByName(long)
