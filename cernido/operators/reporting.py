"""Summaries, rollups and listings over runs, pages, chunks and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cernido.tables import latest


def entity_summary(entities: DataFrame) -> DataFrame:
    """Counts by type, by source, and by both, in one pass: grouping sets.
    ``level`` tells which; the absent column is null."""
    return (
        entities.groupingSets([["entity_type"], ["source"], ["entity_type", "source"]], "entity_type", "source")
        .agg(F.count("*").alias("entities"), F.grouping_id().alias("level"))
        .select("entity_type", "source", "entities", F.col("level").cast("int").alias("level"))
    )


def page_rollup(pages: DataFrame) -> DataFrame:
    """(file_id, total, completed, pending, failed, status) from the latest page
    rows: failed pages fail the file, else open ones keep it waiting."""
    def having(*states: str) -> Column:
        return F.count(F.when(F.col("status").isin(*states), 1))

    rows = latest(pages, ["file_id", "page_number"])
    out = rows.groupBy("file_id").agg(
        F.count("*").alias("total"), having("completed").alias("completed"), having("failed", "quarantined").alias("failed"),
        F.coalesce(F.max("char_count"), F.lit(0)).alias("most_chars"), F.sum("word_count").alias("words"),
        F.round(F.coalesce(F.avg("total_image_ratio"), F.lit(0.0)), 6).alias("image_share"),
    )
    waiting = F.col("total") - F.col("completed") - F.col("failed")
    return out.withColumn("pending", waiting).withColumn(
        "file_status", F.when(F.col("failed") > 0, "failed").when(F.col("pending") > 0, "waiting").otherwise("completed")
    )


def consecutive_pages(pages: DataFrame, method: str | None = None) -> DataFrame:
    """(file_id, first_page, last_page, pages): runs of consecutive page numbers,
    as gaps and islands."""
    rows = latest(pages, ["file_id", "page_number"])
    rows = rows if method is None else rows.filter(F.col("method") == method)
    place = F.col("page_number") - F.row_number().over(Window.partitionBy("file_id").orderBy("page_number"))
    return (
        rows.withColumn("island", place).groupBy("file_id", "island")
        .agg(F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"), F.count("*").alias("pages")).drop("island")
    )


def reindexed(chunks: DataFrame) -> DataFrame:
    """Chunks numbered anew from 1 by page and old index: (chunk_id, new_index, new_chunk_id)."""
    rows = latest(chunks.select("chunk_id", "file_id", "page_start", "page_end", "chunk_index", "updated_at"), ["chunk_id"])
    n = F.row_number().over(Window.partitionBy("file_id").orderBy("page_start", "page_end", "chunk_index", "chunk_id"))
    return rows.select("chunk_id", n.alias("new_index"), F.format_string("%s:c%06d", F.col("file_id"), n).alias("new_chunk_id"))


def chunk_offsets(chunks: DataFrame) -> DataFrame:
    """(chunk_id, start_pos, end_pos): places of the chunks in their file's text,
    joined by one separator: a running sum of lengths."""
    rows = latest(chunks.select("chunk_id", "file_id", "chunk_index", F.length("text").alias("n"), "updated_at"), ["chunk_id"])
    before = Window.partitionBy("file_id").orderBy("chunk_index", "chunk_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0))
    return rows.select("chunk_id", start.cast("long").alias("start_pos"), (start + F.col("n")).cast("long").alias("end_pos"))


def stable_index(entities: DataFrame) -> DataFrame:
    """(file_id, entity_id, dense_index): entities numbered from 0 by their recorded index."""
    rows = latest(entities.select("file_id", "entity_id", "entity_index", "updated_at"), ["file_id", "entity_id"])
    n = F.row_number().over(Window.partitionBy("file_id").orderBy(F.coalesce("entity_index", F.lit(10**9)), "entity_id")) - 1
    return rows.select("file_id", "entity_id", n.alias("dense_index"))


def dedupe_by_value(entities: DataFrame) -> DataFrame:
    """One entity per (file_id, entity_type, value_key): the best by score, then
    recorded index and id, with how many it stands for. One minimum a value,
    combined before the shuffle."""
    rows = latest(entities, ["file_id", "entity_id"])
    key = ["file_id", "entity_type", "value_key"]
    best = F.min(F.struct((-F.col("score")).alias("low"), "entity_index", "entity_id", "score")).alias("best")
    return rows.groupBy(*key).agg(best, F.count("*").alias("evidence_count")).select(*key, "best.entity_id", "best.score", "evidence_count")


def latest_snapshots(runs: DataFrame) -> DataFrame:
    """(user_id, source_type, source_scope_key, run_id, completed_at): the latest
    completed run of each chain; ties go to the greater run_id."""
    per_run = runs.groupBy("run_id", "user_id", "source_type", "source_scope_key").agg(F.max("snapshot_completed_at").alias("completed_at"))
    best = F.max_by("run_id", F.struct("completed_at", "run_id")).alias("run_id")
    return (
        per_run.filter("completed_at is not null").groupBy("user_id", "source_type", "source_scope_key")
        .agg(best, F.max("completed_at").alias("completed_at"))
    )


def run_overview(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Per run: distinct files, uris, extensions and total size; runs without files have zeros."""
    rows = latest(files, ["file_id"]).groupBy("run_id").agg(
        F.count("*").alias("files"), F.count_distinct("source_uri").alias("uris"),
        F.count_distinct(F.lower("extension")).alias("extensions"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"),
    )
    return runs.select("run_id").distinct().join(rows, "run_id", "left").na.fill(0)


def findings_summary(findings: DataFrame) -> DataFrame:
    """Findings by type and level; no level counts as UNKNOWN."""
    return findings.groupBy("pii_type", F.coalesce("confidence_level", F.lit("UNKNOWN")).alias("confidence_level")).agg(F.count("*").alias("findings"))


def findings_projection(findings: DataFrame) -> DataFrame:
    """Exact distinct counts of affected tables, columns and types."""
    return findings.agg(
        F.count_distinct("schema_name").alias("schemas"), F.count_distinct("table_name").alias("tables"),
        F.count_distinct("table_name", "column_name").alias("columns"), F.count_distinct("pii_type").alias("types"), F.count("*").alias("findings"),
    )


def pending_outbox(outbox: DataFrame, limit: int | None = None) -> DataFrame:
    """Deliveries not published yet, oldest first; a limit makes it a top-k report."""
    rows = outbox.filter("published_at is null").select("delivery_no", "queue_name", "status", "attempts", "created_at", F.left("last_error", F.lit(2000)).alias("last_error"))
    return rows.orderBy("created_at", "delivery_no").limit(limit) if limit else rows


def listing(rows: DataFrame, equal: dict[str, object] | None = None, contains: dict[str, str] | None = None) -> DataFrame:
    """A conjunctive filter from parameters: null parameters don't filter,
    ``contains`` is caseless."""
    for c, value in (equal or {}).items():
        rows = rows if value is None else rows.filter(F.col(c) == F.lit(value))
    for c, value in (contains or {}).items():
        rows = rows if value is None else rows.filter(F.lower(c).contains(value.lower()))
    return rows


def chunks_per_page(chunks: DataFrame) -> DataFrame:
    """(file_id, page_start, chunks) from the latest chunk rows."""
    rows = latest(chunks.select("chunk_id", "file_id", "page_start", "updated_at"), ["chunk_id"])
    return rows.groupBy("file_id", "page_start").agg(F.count("*").alias("chunks"))


def file_progress(files: DataFrame, pages: DataFrame) -> DataFrame:
    """(file_id, pages, completed): every file with its pages; files without any have zeros."""
    rows = latest(files.select("file_id", "updated_at"), ["file_id"]).select("file_id")
    done = page_rollup(pages).select("file_id", F.col("total").alias("pages"), "completed")
    return rows.join(done, "file_id", "left").na.fill(0)


def latest_deliveries(outbox: DataFrame) -> DataFrame:
    """(file_id, queue_name, status, attempts) of the last delivery of each file, by
    creation, then number: one maximum a file, combined before the shuffle."""
    last = F.max(F.struct("created_at", "delivery_no", "queue_name", "status", "attempts")).alias("last")
    return outbox.groupBy("file_id").agg(last).select("file_id", "last.queue_name", "last.status", "last.attempts")


def entities_per_chunk(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """(chunk_id, entities, types): every chunk with its recorded entities, zeros where none."""
    rows = latest(chunks.select("chunk_id", "updated_at"), ["chunk_id"]).select("chunk_id")
    found = latest(entities, ["file_id", "entity_id"]).groupBy(F.col("primary_location.chunk_id").alias("chunk_id")).agg(
        F.count("*").alias("entities"), F.count_distinct("entity_type").alias("types")
    )
    return rows.join(found, "chunk_id", "left").na.fill(0)


def profile_summary(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Tables and columns of a profiled source: metadata only."""
    return {"tables": len(tables), "columns": sum(len(df.columns) for df in tables.values())}


def findings_per_table(tables: list[str], findings: DataFrame) -> DataFrame:
    """(table_name, finding_count): every table, zero where nothing was found."""
    every = findings.sparkSession.createDataFrame([(t,) for t in tables], "table_name string")
    return every.join(findings.groupBy("table_name").agg(F.count("*").alias("finding_count")), "table_name", "left").na.fill(0)


def write_artifact(rows: DataFrame, path: str, kind: str, version: str, *by: str) -> None:
    """Rows as JSON documents with their kind and version, in a folder for each
    value of ``by``; an existing artifact of that path is replaced."""
    out = rows.withColumn("artifact_type", F.lit(kind)).withColumn("schema_version", F.lit(version)).write.mode("overwrite")
    (out.partitionBy(*by) if by else out).json(path)
