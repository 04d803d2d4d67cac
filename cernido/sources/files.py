"""Readers of tables and documents. Everything is read on the executors: the
driver only sees file names and schemas."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cernido.functions.textnorm import trimmed
from cernido.tables import bounded_broadcast


def named_columns(names: list[str | None]) -> list[str]:
    """Header cells as column names: blank ones become ``column_<place>``; a name
    that comes again gets its place behind it."""
    out: list[str] = []
    for i, name in enumerate(names, 1):
        name = (name or "").strip() or f"column_{i}"
        out.append(name if name not in out else f"{name}_{i}")
    return out


def read_csv(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """CSV files with a header, all columns as text, blank rows left out. Each
    file is UTF-8 (with or without mark), or Latin-1 where it isn't valid UTF-8.

    Files are read as Latin-1, which keeps every byte. Whether all cells of a
    file are valid UTF-8 is combined within the tasks, one row a file.
    """
    options = {"sep": separator, "multiLine": True, "escape": '"', "encoding": "ISO-8859-1"}
    first = spark.read.csv(path, header=False, inferSchema=False, **options).first()
    if first is None:
        return spark.read.csv(path, header=False, **options)
    names = named_columns([_by_bytes(x) for x in first])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.csv(path, schema, header=True, **options)
    raw = {n: F.encode(F.col(f"`{n}`"), "ISO-8859-1") for n in names}
    cells = df.withColumn("__file", F.col("_metadata.file_path"))
    valid = [F.coalesce(F.is_valid_utf8(x), F.lit(True)) for x in raw.values()]
    files = cells.select("__file", F.forall(F.array(*valid), lambda x: x).alias("ok")).groupBy("__file").agg(F.min("ok").alias("__ok"))
    cells = cells.join(bounded_broadcast(files), "__file")
    return nonblank_rows(cells.select([F.when(F.col("__ok"), F.decode(raw[n], "UTF-8")).otherwise(F.col(f"`{n}`")).alias(n) for n in names]))


def _by_bytes(cell: str | None) -> str:
    """A header cell that was read as Latin-1."""
    raw = (cell or "").encode("latin-1", "replace")
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def nonblank_rows(df: DataFrame) -> DataFrame:
    """Rows with something in at least one cell."""
    return df.filter(F.exists(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]), lambda x: x.isNotNull() & (F.trim(x) != "")))


def column_sample(df: DataFrame, column: str, limit: int, order: list[Column], max_length: int = 256) -> DataFrame:
    """(value, truncated): the first ``limit`` non-blank values by an explicit
    order. A sampling operator: the limit is its purpose."""
    value = trimmed(F.col(f"`{column}`").cast("string"))
    rows = df.filter(value != "").orderBy(*order).limit(limit)
    return rows.select(F.left(value, F.lit(max_length)).alias("value"), (F.length(value) > max_length).alias("truncated"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of text files: UTF-8 without its mark, else Latin-1."""
    raw = spark.read.format("binaryFile").load(path)
    text = F.when(F.is_valid_utf8("content"), F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    return raw.select("path", F.regexp_replace(text, "^﻿", "").alias("text"))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def docx_blocks(content: bytes) -> list[tuple[str, str]]:
    """(kind, text) of paragraphs and tables in the order of the body. Cells of a
    row are joined by `` | ``, rows by line ends; blank ones are left out."""

    def text_of(node) -> str:
        return "".join(t.text or "" for t in node.iter(f"{_W}t")).strip()

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    out = []
    for node in body if body is not None else []:
        if node.tag == f"{_W}p":
            out.append(("paragraph", text_of(node)))
        elif node.tag == f"{_W}tbl":
            rows = [[text_of(c) for c in row.iter(f"{_W}tc")] for row in node.iter(f"{_W}tr")]
            lines = [" | ".join(c for c in row if c) for row in rows]
            out.append(("table", "\n".join(x for x in lines if x)))
    return [(kind, text) for kind, text in out if text]


def xlsx_rows(content: bytes) -> list[tuple[str, int, list[str]]]:
    """(sheet, row number, cells) of the visible sheets, cached values as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet"):
            if sheet.get("state", "visible") != "visible":
                continue
            target = links[sheet.get(f"{_R}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for row in root.iter(f"{_S}row"):
                cells: dict[int, str] = {}
                for c in row.iter(f"{_S}c"):
                    letters = re.match(r"[A-Z]+", c.get("r", "A")).group()
                    place = 0
                    for x in letters:
                        place = place * 26 + ord(x) - 64
                    value = c.find(f"{_S}v")
                    if c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                    elif value is None:
                        continue
                    else:
                        text = shared[int(value.text)] if c.get("t") == "s" else value.text or ""
                    cells[place] = text
                if cells:
                    out.append((sheet.get("name"), int(row.get("r", 0)), [cells.get(i, "") for i in range(1, max(cells) + 1)]))
    return out


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.parts.append(data.strip())


def html_text(html: str | None) -> str | None:
    """The text nodes of a page, trimmed and joined by blanks."""
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return " ".join(parser.parts)


@F.pandas_udf(T.StringType())
def html_text_col(pages: pd.Series) -> pd.Series:
    return pages.map(html_text, na_action="ignore")


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """(path, block_index, block_type, text, error) of Word files. A broken file
    gives one row with its error and never stops the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(name, i, kind, text, None) for i, (kind, text) in enumerate(docx_blocks(content), 1)]
                except Exception as problem:
                    rows.append((name, 0, None, None, f"{type(problem).__name__}: {problem}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "block_index", "block_type", "text", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, block_index int, block_type string, text string, error string")


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row, cells array, error) of spreadsheets, read on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(name, sheet, n, cells, None) for sheet, n, cells in xlsx_rows(content)]
                except Exception as problem:
                    rows.append((name, None, 0, None, f"{type(problem).__name__}: {problem}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, sheet string, row int, cells array<string>, error string")


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """(source_uri, file_name, extension, size_bytes, modified_at) of a folder's
    files at every depth; contents aren't read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return raw.select(
        F.col("path").alias("source_uri"), name.alias("file_name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("extension"),
        F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"),
    )
