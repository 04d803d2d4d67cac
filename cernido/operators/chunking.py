"""Source blocks to normalized, overlapping chunks with an exact source map."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cernido.functions.textnorm import chunk_text


@dataclass(frozen=True)
class Sizes:
    target: int = 1500
    most: int = 2500
    least: int = 400
    overlap: int = 200


SEGMENT = (
    "struct<source_block_id:string,page_number:int,block_index:int,source_text_start:int,source_text_end:int,"
    "chunk_text_start:int,chunk_text_end:int,is_overlap:boolean>"
)
CHUNKS = f"array<struct<text:string,segments:array<{SEGMENT}>>>"


def block_spans(length: int, text: str, sizes: Sizes) -> list[tuple[int, int]]:
    """Cuts of one block into spans of at most ``most`` characters, after the last
    blank that leaves at least ``least``; without one, at the limit."""
    spans, at = [], 0
    while at < length:
        end = min(at + sizes.most, length)
        if end < length:
            blank = text.rfind(" ", at, end)
            end = blank + 1 if blank >= at + sizes.least else end
        a, b = at, end
        while a < b and text[a] == " ":
            a += 1
        while b > a and text[b - 1] == " ":
            b -= 1
        if b > a:
            spans.append((a, b))
        at = end
    return spans


def group_lengths(lengths: list[int], sizes: Sizes) -> list[int]:
    """How many spans each chunk takes. A chunk closes once it has the least
    size and another span would pass the target. A last chunk below the least
    is merged into the one before, or both are split again as evenly as allowed."""
    counts: list[int] = []
    size = 0
    for n in lengths:
        if counts and size >= sizes.least and size + 1 + n > sizes.target:
            counts.append(1)
            size = n
        elif counts:
            counts[-1] += 1
            size += 1 + n
        else:
            counts, size = [1], n
    if len(counts) < 2 or size >= sizes.least:
        return counts
    tail = lengths[len(lengths) - counts[-1] - counts[-2] :]
    joined = sum(tail) + len(tail) - 1
    if joined <= sizes.most:
        return [*counts[:-2], len(tail)]
    options = []
    for k in range(1, len(tail)):
        left, right = sum(tail[:k]) + k - 1, sum(tail[k:]) + len(tail) - k - 1
        if right >= sizes.least and left <= sizes.most:
            options.append((abs(left - right), k))
    if options:
        k = min(options)[1]
        return [*counts[:-2], k, len(tail) - k]
    return counts


def page_chunks(blocks: list[tuple[str, int, int, str]], sizes: Sizes) -> list[dict]:
    """Chunks of one page from (block id, page, block index, normalized text)."""
    spans = [(block, a, b) for block in blocks for a, b in block_spans(len(block[3]), block[3], sizes)]
    out, at, before = [], 0, []
    for n in group_lengths([b - a for _, a, b in spans], sizes):
        group = spans[at : at + n]
        at += n
        tail, left = [], sizes.overlap
        for block, a, b in reversed(before):
            if left <= 0:
                break
            tail.append((block, max(a, b - left), b))
            left -= min(left, b - a)
        parts = [(*s, True) for s in reversed(tail)] + [(*s, False) for s in group]
        segments, texts, place = [], [], 0
        for (block_id, page, index, text), a, b, again in parts:
            segments.append({
                "source_block_id": block_id, "page_number": page, "block_index": index, "source_text_start": a, "source_text_end": b,
                "chunk_text_start": place, "chunk_text_end": place + b - a, "is_overlap": again,
            })
            texts.append(text[a:b])
            place += b - a + 1
        out.append({"text": " ".join(texts), "segments": segments})
        before = group
    return out


def build_chunks(blocks: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Chunks of each file: file_id, chunk_id, chunk_index (from 1), page_start,
    page_end, text, text_hash_sha256, segments.

    Blocks need source_block_id, file_id, page_number, block_index and text.
    Chunks never span pages, so pages are built apart and in parallel; a page
    is the largest unit that one task holds. Blank blocks give nothing.
    """
    rows = blocks.select("file_id", "page_number", "block_index", "source_block_id", chunk_text(F.col("text")).alias("text")).filter("text <> ''")
    pages = rows.groupBy("file_id", "page_number").agg(
        F.array_sort(F.collect_list(F.struct("block_index", "source_block_id", "text"))).alias("blocks")
    )

    @F.pandas_udf(CHUNKS)
    def build(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, found in parts:
            yield pd.Series([
                page_chunks([(b["source_block_id"], int(p), b["block_index"], b["text"]) for b in bs], sizes) for p, bs in zip(page, found, strict=True)
            ])

    each = pages.select("file_id", "page_number", F.posexplode(build("page_number", "blocks")).alias("at", "chunk"))
    index = F.row_number().over(Window.partitionBy("file_id").orderBy("page_number", "at"))
    return each.withColumn("chunk_index", index).select(
        "file_id", F.format_string("%s:c%06d", "file_id", "chunk_index").alias("chunk_id"), "chunk_index",
        F.col("page_number").alias("page_start"), F.col("page_number").alias("page_end"), "chunk.text",
        F.sha2(F.col("chunk.text"), 256).alias("text_hash_sha256"), "chunk.segments",
    )


def paragraph_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of plain text: lines trimmed, a blank line closes a block, blocks
    numbered from 1. One page per document."""
    lines = F.transform(F.split(F.col(text_col), r"\r\n|\r|\n"), lambda x: F.trim(x))
    joined = F.array_join(lines, "\n")
    parts = F.filter(F.split(joined, r"\n\n+"), lambda p: F.trim(F.regexp_replace(p, r"\n", "")) != "")
    each = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("file_id"), F.posexplode(parts).alias("at", "block"))
    return each.select(
        "file_id", F.lit(1).alias("page_number"), (F.col("at") + 1).alias("block_index"),
        F.format_string("%s:p1:b%04d", F.col("file_id"), F.col("at") + 1).alias("source_block_id"),
        F.regexp_replace("block", r"^\n+|\n+$", "").alias("text"),
    )


def trace(entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """Where entities of a chunk lie in their source: one row per entity and
    segment that they overlap, with clipped and projected offsets."""
    both = entities.join(chunks.select("chunk_id", "segments"), "chunk_id").select(entities["*"], F.inline("segments"))
    a, b = F.greatest("start_pos", "chunk_text_start"), F.least("end_pos", "chunk_text_end")
    return both.filter(a < b).select(
        *entities.columns, "source_block_id", "page_number", "block_index", a.alias("chunk_start"), b.alias("chunk_end"),
        (F.col("source_text_start") + a - F.col("chunk_text_start")).alias("source_start"),
        (F.col("source_text_start") + b - F.col("chunk_text_start")).alias("source_end"), "is_overlap",
    )
