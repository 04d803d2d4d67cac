"""Splitting oversized texts at natural boundaries, by content.

A rolling hash over the last characters marks landmarks. The cut is the natural
boundary nearest to the first landmark between the least and the greatest size,
so it depends on the text around it only and an edit moves neighbouring cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cernido.tables import bounded_broadcast, latest

WINDOW = 32
#: natural boundaries, strongest first; a cut comes after the match
BOUNDARIES = [re.compile(p) for p in (r"\n[ \t]*\n\s*", r"\n\s*", r"(?<=[.!?…。！？])[\"'»”)\]]*\s+|[。！？]", r"\s+")]


def _gear() -> np.ndarray:
    """A fixed pseudo-random 32-bit number for each of 65,536 character classes."""
    x = np.arange(1, 65537, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def landmarks(text: str, mean_gap: int) -> np.ndarray:
    """Positions after which the rolling hash of WINDOW characters is a landmark."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    values = _GEAR[codes & 0xFFFF]
    sums = np.zeros(len(codes), dtype=np.uint32)
    for back in range(min(WINDOW, len(codes))):
        sums[back:] += values[: len(values) - back] << np.uint32(back)
    bits = max(1, int(mean_gap).bit_length() - 1)
    return np.nonzero((sums >> np.uint32(32 - bits)) == 0)[0] + 1


def split_text(text: str, max_chars: int, overlap_chars: int) -> list[tuple[int, int]]:
    """Spans [start, end) of the pieces, each at most ``max_chars`` long.

    A text within the limit is one piece. Each piece but the first starts about
    ``overlap_chars`` before the end of the one before, at a word where there
    is one. Where the window has no blank at all, the cut falls on the landmark.
    """
    n = len(text)
    if n <= max_chars:
        return [(0, n)]
    overlap = max(0, min(overlap_chars, max_chars // 2))
    least = max(1, (max_chars - overlap) // 3)
    marks = landmarks(text, max(2, (max_chars - overlap) // 4))
    ends = [np.array([m.end() for m in p.finditer(text)], dtype=np.int64) for p in BOUNDARIES]
    words = ends[-1]
    pieces, cut, start = [], 0, 0
    while n - start > max_chars:
        low, high = cut + least, start + max_chars
        i = np.searchsorted(marks, low)
        aim = int(marks[i]) if i < len(marks) and marks[i] <= high else high
        end = aim
        for level in ends:
            a, b = np.searchsorted(level, low), np.searchsorted(level, high, side="right")
            if b > a:
                inside = level[a:b]
                end = int(inside[np.argmin(np.abs(inside - aim))])
                break
        pieces.append((start, end))
        cut, back = end, end - overlap
        i = np.searchsorted(words, back)
        start = int(words[i]) if overlap and i < len(words) and words[i] < end else back
    pieces.append((start, n))
    return pieces


def with_limits(chunks: DataFrame, pages: DataFrame, limits: DataFrame) -> DataFrame:
    """The latest rows of oversized chunks with max_chars and overlap_chars.

    Which row of a chunk is the latest is found without its text. Only texts
    longer than the least limit are read for the join, so the shuffle holds the
    oversized ones. A chunk without a method takes that of the page at
    page_start; without that it has no limit and stays whole.
    """
    limit = bounded_broadcast(limits.select(F.col("method").alias("kind"), "max_chars", "overlap_chars"))
    lowest = limits.agg(F.min("max_chars").alias("lowest"))
    newest = latest(chunks.select("chunk_id", "updated_at"), ["chunk_id"])
    long = chunks.crossJoin(F.broadcast(lowest)).filter(F.length("text") > F.col("lowest"))  # one row beside each
    rows = long.join(newest, [long.chunk_id == newest.chunk_id, long.updated_at.eqNullSafe(newest.updated_at)], "left_semi")
    rows = rows.dropDuplicates(["chunk_id"]).select("chunk_id", "file_id", "chunk_index", "page_start", "page_end", "text", "method")
    page = latest(pages.select("file_id", "page_number", F.col("method").alias("page_method"), "updated_at"), ["file_id", "page_number"])
    page = page.select("file_id", F.col("page_number").alias("page_start"), "page_method")
    named = rows.filter("method is not null").withColumn("kind", F.col("method"))
    other = rows.filter("method is null").join(page, ["file_id", "page_start"]).withColumnRenamed("page_method", "kind")
    return named.unionByName(other).join(limit, "kind").filter(F.length("text") > F.col("max_chars"))


PIECES = "array<struct<piece_no:int,start_pos:int,end_pos:int,text:string,page_start:int,page_end:int>>"


def split_oversized(rows: DataFrame) -> DataFrame:
    """The rows with their ``pieces``. Needs text, max_chars, overlap_chars,
    page_start and page_end; a piece lies on the pages of its share of the text."""

    @F.pandas_udf(PIECES)
    def cut(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for text, most, overlap, first, last in parts:
            yield pd.Series([_pieces(*x) for x in zip(text, most, overlap, first, last, strict=True)])

    return rows.withColumn("pieces", cut("text", "max_chars", "overlap_chars", "page_start", "page_end"))


def _pieces(text, most, overlap, first, last) -> list[dict]:
    pages = 1 if pd.isna(first) or pd.isna(last) else int(last) - int(first) + 1
    base = None if pd.isna(first) else int(first)
    n = len(text)

    def page(at: int):
        return None if base is None else base + min(pages - 1, at * pages // n)

    return [
        {"piece_no": i, "start_pos": a, "end_pos": b, "text": text[a:b], "page_start": page(a), "page_end": page(b - 1)}
        for i, (a, b) in enumerate(split_text(text, int(most), int(overlap)))
    ]


def oversized(chunks: DataFrame, pages: DataFrame, limits: DataFrame) -> DataFrame:
    """(chunk_id, file_id, chunk_index, pieces) of the chunks that need splitting."""
    return split_oversized(with_limits(chunks, pages, limits)).filter(F.size("pieces") > 1)


def resplit(chunks: DataFrame, pages: DataFrame, limits: DataFrame) -> DataFrame:
    """All chunks of the latest rows, oversized ones in pieces, with a new
    chunk_index from 1 by file: (file_id, source_chunk_id, piece_no,
    chunk_index, page_start, page_end, text).

    The new index is a running sum of piece counts. It is summed over blocks of
    old indices first, so no task holds more than a block of a hot file.
    """
    cut = oversized(chunks, pages, limits)
    pieces = cut.select("file_id", "chunk_id", "chunk_index", F.inline("pieces"))
    newest = latest(chunks.select("chunk_id", "file_id", "chunk_index", "page_start", "page_end", "text", "updated_at"), ["chunk_id"])
    whole = newest.join(cut.select("chunk_id"), "chunk_id", "left_anti").select(
        "file_id", "chunk_id", "chunk_index", F.lit(0).alias("piece_no"), "page_start", "page_end", "text"
    )
    both = whole.unionByName(pieces.select(*whole.columns))
    block = F.floor(F.col("chunk_index") / 1024)
    placed = both.withColumn("block", block)
    sums = placed.groupBy("file_id", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("file_id", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("file_id", "block").orderBy("chunk_index", "chunk_id", "piece_no"))
    return (
        placed.withColumn("within", inner)
        .join(sums, ["file_id", "block"])
        .select(
            "file_id", F.col("chunk_id").alias("source_chunk_id"), "piece_no",
            (F.col("before") + F.col("within")).cast("int").alias("chunk_index"), "page_start", "page_end", "text",
        )
    )
