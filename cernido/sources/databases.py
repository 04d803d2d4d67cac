"""Database and REST sources, and the guard of the review path."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: what a statement that begins with WITH may do besides reading
_WRITES = re.compile(r"(?i)\b(?:insert\s+(?:into|overwrite)|merge\s+into|delete\s+from|update\s+\S+\s+set)\b")


def guarded_sql(spark: SparkSession, statement: str, **frames: DataFrame) -> DataFrame:
    """Runs one reading statement (SELECT or WITH) and nothing else. Strings,
    quoted names and comments may hold anything."""
    quoted = r"'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\"\"|\\.)*\"|`(?:[^`]|``)*`"
    bare = re.sub(rf"({quoted})|--[^\n]*|/\*.*?\*/", lambda m: m.group(1) or " ", statement, flags=re.S).strip().rstrip(";").strip()
    outside = re.sub(quoted, "q", bare, flags=re.S)
    if not re.match(r"(?i)(select|with)\b", outside) or ";" in outside:
        raise ValueError("only a single SELECT or WITH statement is allowed")
    if _WRITES.search(outside):
        raise ValueError("only reading statements are allowed")
    return spark.sql(bare, **frames)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A database table; with a numeric key it is read in parallel ranges.
    Column selection and filters are pushed down by the JDBC source."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key is not None:
        reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def in_scope(df: DataFrame, schemas: list[str] | None, tables: list[str] | None, system: list[str] = ("information_schema", "pg_catalog", "sys", "system")) -> DataFrame:
    """Relations (schema_name, table_name) of a scope, caseless; system schemas
    are left out only where no list is given."""
    if schemas:
        df = df.filter(F.lower("schema_name").isin([s.lower() for s in schemas]))
    else:
        df = df.filter(~F.lower(F.coalesce("schema_name", F.lit(""))).isin(list(system)))
    return df.filter(F.lower("table_name").isin([t.lower() for t in tables])) if tables else df


def row_estimate(estimate):
    """A catalog's row estimate: negative is unknown."""
    return F.when(estimate >= 0, estimate)


def read_pages(
    spark: SparkSession, statement: str, fetch: Callable[[str, int, int], str], total: int, page_size: int = 1000, schema: str = "items string", max_pages: int = 10_000
) -> DataFrame:
    """A paged REST-SQL service: ``fetch(statement, offset, limit)`` gives a JSON
    text with ``items`` and ``hasMore``. Ranges of ``page_size`` offsets are
    partitions, so pages are read in parallel on the executors; ``total`` comes
    from the service's count. A service may give fewer rows than asked for: each
    range goes on from the rows received until it is full or ``hasMore`` is
    false, and the last range also past ``total`` while ``hasMore`` is true.
    Fails where a page doesn't advance or a range takes over ``max_pages``."""
    last = (max(total, 1) - 1) // page_size * page_size
    offsets = spark.range(0, last + 1, page_size, last // page_size + 1)

    def items_from(start: int) -> Iterator:
        at, end = start, min(start + page_size, total)
        for _ in range(max_pages):
            page = json.loads(fetch(statement, at, page_size if start == last else end - at))
            items, more = page["items"], page.get("hasMore")
            yield from items if start == last else items[: end - at]
            at += len(items)
            if more is False or (at >= end and not (more and start == last)):
                return
            if not items:
                raise ValueError(f"the service has more rows but gave none at offset {at}")
        raise ValueError(f"more than {max_pages} pages from offset {start}")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"item": [json.dumps(item, sort_keys=True) for at in batch["id"] for item in items_from(int(at))]}, dtype=object)

    raw = offsets.mapInPandas(run, "item string")
    return raw if schema == "items string" else raw.select(F.from_json("item", schema).alias("r")).select("r.*")
