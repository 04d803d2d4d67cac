"""Review of results: listings, lookups, measures of pages and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cernido.functions import validators as v
from cernido.operators.reporting import page_rollup
from cernido.tables import latest


def recent_files(files: DataFrame, pages: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` files with pages that were updated last, by name where they tie (a top-k report)."""
    rows = latest(files, ["file_id"]).select("file_id", "file_name", "updated_at")
    return rows.join(page_rollup(pages).select("file_id", "total", "completed"), "file_id").orderBy(F.desc("updated_at"), "file_name", "file_id").limit(n)


def guarded_delivery(files: DataFrame, outbox: DataFrame) -> DataFrame:
    """(file_id, run_id, delivered): every file with the status of its last delivery,
    null unless that was for the same run."""
    rows = latest(files.select("file_id", "run_id", "updated_at"), ["file_id"]).drop("updated_at")
    last = outbox.groupBy("file_id").agg(F.max(F.struct("created_at", "delivery_no", "run_id", "status")).alias("o"))
    return rows.join(last, "file_id", "left").select("file_id", "run_id", F.when(F.col("o.run_id") == F.col("run_id"), F.col("o.status")).alias("delivered"))


def file_overview(files: DataFrame, outbox: DataFrame, pages: DataFrame, chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """Every file with five lookups: the status of its last delivery to a text and
    to a table queue, its pages' status, its chunks and its entities. Each is one
    aggregate by file, joined; none is a subquery for each row."""
    to_table = F.col("queue_name") == "Queue-Tables"
    order = F.struct("created_at", "delivery_no")
    sent = outbox.groupBy("file_id").agg(
        F.max_by(F.when(~to_table, F.col("status")), F.when(~to_table, order)).alias("text_status"),
        F.max_by(F.when(to_table, F.col("status")), F.when(to_table, order)).alias("table_status"),
    )
    n_chunks = latest(chunks.select("chunk_id", "file_id", "updated_at"), ["chunk_id"]).groupBy("file_id").agg(F.count("*").alias("chunks"))
    n_entities = latest(entities.select("file_id", "entity_id", "updated_at"), ["file_id", "entity_id"]).groupBy("file_id").agg(F.count("*").alias("entities"))
    rows = latest(files.select("file_id", "updated_at"), ["file_id"]).select("file_id")
    for side in (sent, page_rollup(pages).select("file_id", "file_status"), n_chunks, n_entities):
        rows = rows.join(side, "file_id", "left")
    return rows.na.fill(0, ["chunks", "entities"])


def active_elsewhere(runs: DataFrame) -> DataFrame:
    """(run_id) of runs in whose scope another run is active, that is has no row with
    a finishing time. By the least and the greatest active run of a scope."""
    scope = ["user_id", "source_type", "source_scope_key"]
    per = runs.groupBy("run_id", *scope).agg(F.max("finished_at").alias("finished"))
    active = per.filter("finished is null").groupBy(*scope).agg(F.min("run_id").alias("lo"), F.max("run_id").alias("hi"))
    return per.join(active, scope).filter("lo <> run_id or hi <> run_id").select("run_id")


def column_rows(columns: DataFrame, relations: DataFrame) -> DataFrame:
    """The columns (schema_name, table_name, ...) of the selected relations, whatever the letter case."""
    key = [F.lower(F.coalesce(c, F.lit(""))) for c in ("schema_name", "table_name")]
    left = columns.withColumns({"__s": key[0], "__t": key[1]})
    return left.join(relations.select(key[0].alias("__s"), key[1].alias("__t")), ["__s", "__t"], "left_semi").drop("__s", "__t")


def chunk_listing(chunks: DataFrame, preview: int = 80) -> DataFrame:
    """(file_id, chunk_id, place, preview): chunks of a file in order of page and
    index, with the beginning of their text."""
    rows = latest(chunks.select("chunk_id", "file_id", "page_start", "chunk_index", F.left("text", F.lit(preview)).alias("preview"), "updated_at"), ["chunk_id"])
    place = F.row_number().over(Window.partitionBy("file_id").orderBy("page_start", "chunk_index", "chunk_id"))
    return rows.select("file_id", "chunk_id", place.alias("place"), "preview")


def ready_chunks(chunks: DataFrame) -> DataFrame:
    """(file_id, chunk_id, ordinal): chunks that are ready, numbered in order of index."""
    rows = latest(chunks.select("chunk_id", "file_id", "chunk_index", "status", "updated_at"), ["chunk_id"]).filter("status = 'ready'")
    return rows.select("file_id", "chunk_id", F.row_number().over(Window.partitionBy("file_id").orderBy("chunk_index", "chunk_id")).alias("ordinal"))


def newest_first(files: DataFrame) -> DataFrame:
    """(run_id, file_id, ordinal): a run's files from the newest, ties by file_id."""
    rows = latest(files.select("file_id", "run_id", "updated_at"), ["file_id"])
    return rows.select("run_id", "file_id", F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("updated_at"), "file_id")).alias("ordinal"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two times, not below 0; null if one is missing."""
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest((F.unix_micros(end) - F.unix_micros(start)) / 1e6, F.lit(0.0)))


def page_measures(pages: DataFrame) -> DataFrame:
    """(file_id, seconds, wall, share): the sum of the pages' times, six digits; the
    time from the first to the last of pages with recognition that have both;
    and that by page. Files without such pages have zeros."""
    rows = latest(pages, ["file_id", "page_number"])
    read = F.col("method").isin("ocr", "both") & F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()
    out = rows.groupBy("file_id").agg(
        F.round(F.coalesce(F.sum(elapsed_seconds(F.col("created_at"), F.col("updated_at"))), F.lit(0.0)), 6).alias("seconds"),
        F.round(F.coalesce(elapsed_seconds(F.min(F.when(read, F.col("created_at"))), F.max(F.when(read, F.col("updated_at")))), F.lit(0.0)), 6).alias("wall"),
        F.count_if(read).alias("n"),
    )
    return out.select("file_id", "seconds", "wall", F.round(F.col("wall") / F.greatest("n", F.lit(1)), 6).alias("share"))


def chunk_pages(chunks: DataFrame) -> DataFrame:
    """(file_id, first_page, last_page, method, pages): the pages of a file's chunks,
    the distinct first ones in order, and the method of the first chunk that has one."""
    rows = latest(chunks.select("chunk_id", "file_id", "page_start", "page_end", "chunk_index", "method", "updated_at"), ["chunk_id"])
    first = F.when(F.col("method").isNotNull(), F.struct("page_start", "chunk_index", "chunk_id"))
    return rows.groupBy("file_id").agg(
        F.min("page_start").alias("first_page"), F.max("page_end").alias("last_page"), F.min_by("method", first).alias("method"),
        F.array_join(F.array_sort(F.collect_set("page_start")), ",").alias("pages"),
    )


def text_counts(text: Column) -> tuple[Column, Column]:
    """Characters of the trimmed text, and words (runs without blanks); null counts as empty."""
    return F.coalesce(F.length(F.btrim(text, F.lit(" \t\n\r\f\x0b"))), F.lit(0)), F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def uuid5(name: Column, namespace: str = "6ba7b811-9dad-11d1-80b4-00c04fd430c8") -> Column:
    """The name-based UUID of a name in a namespace (that of URLs), from its SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat_ws("-", *parts)


def value_ratios(df: DataFrame, columns: list[str], least: int = 2, most: int = 5) -> DataFrame:
    """(column_name, names, textual): which share of a column's non-blank values is
    like a name, and which holds a letter; 0 where there are none."""
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.btrim(F.col(c).cast("string")).alias("x")) for c in columns])))
    some = F.nullif("x", F.lit(""))
    mean = lambda ok: F.round(F.coalesce(F.avg(F.when(some.isNotNull(), ok.cast("int"))), F.lit(0.0)), 6)
    return values.groupBy("column_name").agg(mean(v.name_like(F.col("x"), least, most)).alias("names"), mean(F.col("x").rlike("[A-Za-z]")).alias("textual"))
