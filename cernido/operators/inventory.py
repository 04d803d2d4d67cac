"""File inventory: routes, revision keys, snapshot states, tombstones, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cernido.functions.textnorm import extension, mime_type, nonblank
from cernido.operators.snapshots import CHAIN, completed_runs
from cernido.tables import latest

# What extensions and MIME types are routed to.
BY_EXTENSION = {
    ("pdf", "Queue-PDF", "pdf_extension"): (".pdf",),
    ("ocr", "Queue-OCR", "image_extension"): (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp"),
    ("table", "Queue-Tables", "tabular_extension"): (".csv", ".xlsx", ".xlsm"),
    ("doc", "Queue-Doc", "document_extension"): (".txt", ".docx"),
    ("unsupported", "Queue-Unsupported", "legacy_excel_not_supported"): (".xls",),
    ("unsupported", "Queue-Unsupported", "legacy_word_not_supported"): (".doc",),
}
NATIVE = "application/vnd.google-apps."
BY_MIME = {
    ("pdf", "Queue-PDF", "pdf_mime"): ("application/pdf",),
    ("doc", "Queue-Doc", "google_document_mime"): ("application/vnd.google-apps.document",),
    ("table", "Queue-Tables", "google_spreadsheet_mime"): ("application/vnd.google-apps.spreadsheet",),
    ("doc", "Queue-Doc", "google_presentation_mime"): ("application/vnd.google-apps.presentation",),
    ("table", "Queue-Tables", "tabular_mime"): (
        "text/csv", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.ms-excel.sheet.macroenabled.12",
    ),
    ("doc", "Queue-Doc", "document_mime"): ("text/plain", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
}


def _route(kind: str, queue: str, reason: str) -> Column:
    status = "unsupported" if kind == "unsupported" else "routed"
    return F.struct(F.lit(kind).alias("route_type"), F.lit(queue).alias("queue"), F.lit(reason).alias("reason"), F.lit(status).alias("route_status"))


def route(ext: Column, mime: Column) -> Column:
    """struct<route_type, queue, reason, route_status> of a file: native formats
    by MIME type, else by extension, else by MIME type."""
    e, m = extension(ext), mime_type(mime)
    lost = ("unsupported", "Queue-Unsupported")
    by_mime = F.when(m == "", _route(*lost, "missing_extension"))
    for key, names in BY_MIME.items():
        by_mime = by_mime.when(m.isin(*names), _route(*key))
    by_mime = by_mime.when(F.startswith(m, F.lit("image/")), _route("ocr", "Queue-OCR", "image_mime")).otherwise(_route(*lost, "unsupported_mime_type"))
    by_ext = F.when(F.lit(False), _route(*lost, ""))
    for key, names in BY_EXTENSION.items():
        by_ext = by_ext.when(e.isin(*names), _route(*key))
    by_ext = by_ext.otherwise(_route(*lost, "unsupported_extension"))
    return F.when(F.startswith(m, F.lit(NATIVE)) | (e == ""), by_mime).otherwise(by_ext)


def revision_key() -> Column:
    """The most reliable version of a file: checksum, content hash, etag; null if none."""
    def named(prefix: str, column: str) -> Column:
        return F.concat(F.lit(f"{prefix}:"), nonblank(F.col(column)))

    return F.coalesce(named("sha256", "checksum_sha256"), named("content", "content_hash"), named("etag", "etag"))


def idempotency_key(route_type: Column, version: str = "v1") -> Column:
    """Key of a routed message: the same file revision and route give the same key."""
    def have(c: str) -> Column:
        return F.nullif(F.col(c).cast("string"), F.lit(""))

    size = F.when(F.col("size_bytes") != 0, F.col("size_bytes").cast("string"))
    revision = F.coalesce(have("content_hash"), have("etag"), have("checksum_sha256"), size, F.lit("unknown"))
    return F.concat_ws(":", F.lit("file.routed"), "run_id", "file_id", revision, route_type, F.lit(version))


def snapshot_state(prior_exists: Column, current: Column, prior: Column, reusable: Column, force: Column) -> Column:
    """new, modified, reprocessed or reused; an unknown revision counts as modified."""
    return (
        F.when(~prior_exists, "new").when(current.isNull() | prior.isNull() | (current != prior), "modified")
        .when(force | ~reusable, "reprocessed").otherwise("reused")
    )


def reusable(route_type: Column, route_status: Column, text_status: Column, table_status: Column, entity_status: Column) -> Column:
    """Whether the results of a file's earlier revision can serve again, by its route."""
    done = (
        F.when(route_type == "unsupported", route_status == "unsupported")
        .when(route_type == "table", table_status.isin("table_profile_completed", "table_discovery_completed"))
        .when(route_type.isin("pdf", "doc", "ocr"), (text_status == "text_extraction_completed") & (entity_status == "entity_extraction_completed"))
    )
    return F.coalesce(done, F.lit(False))


def snapshot_states(files: DataFrame, runs: DataFrame, results: DataFrame | None = None, force: bool = False) -> DataFrame:
    """(run_id, file_id, source_uri, state, previous_file_id) of completed runs: each
    listed file against the latest earlier completed run of its chain that
    lists the same uri (an as-of join, as a window over one uri of one chain).
    ``results``: (file_id, reusable) of earlier files; a file that isn't in them
    has nothing to reuse. Without ``results`` every earlier result can be reused."""
    rows = latest(files, ["file_id"]).drop(*CHAIN).join(completed_runs(runs).select("run_id", *CHAIN, "seq"), "run_id")
    rows = rows.withColumn("revision", revision_key())
    before = Window.partitionBy(*CHAIN, "source_uri").orderBy("seq", "file_id")
    rows = rows.select(
        "run_id", "file_id", "source_uri", "revision", F.lag("file_id").over(before).alias("previous_file_id"), F.lag("revision").over(before).alias("prior")
    )
    can = F.lit(True)
    if results is not None:
        served = results.select(F.col("file_id").alias("previous_file_id"), F.col("reusable").alias("__can"))
        rows, can = rows.join(served, "previous_file_id", "left"), F.coalesce(F.col("__can"), F.lit(False))
    state = snapshot_state(F.col("previous_file_id").isNotNull(), F.col("revision"), F.col("prior"), can, F.lit(force))
    return rows.select("run_id", "file_id", "source_uri", state.alias("state"), "previous_file_id")


def tombstones(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, source_uri, previous_file_id): files of the run just before that the
    run doesn't list. Anti-join on (run, uri)."""
    known = completed_runs(runs)
    listed = latest(files.select("file_id", "run_id", "source_uri", "updated_at"), ["file_id"]).drop("updated_at")
    before = listed.join(known.select("run_id", "next_run_id").filter("next_run_id is not null"), "run_id")
    before = before.select(F.col("next_run_id").alias("run_id"), "source_uri", F.col("file_id").alias("previous_file_id"))
    return before.join(listed.select("run_id", "source_uri"), ["run_id", "source_uri"], "left_anti")


def snapshot_counters(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, new, modified, reused, reprocessed, deleted) of completed runs."""
    states = snapshot_states(files, runs).groupBy("run_id").agg(
        *[F.count(F.when(F.col("state") == s, 1)).alias(s) for s in ("new", "modified", "reused", "reprocessed")]
    )
    gone = tombstones(files, runs).groupBy("run_id").agg(F.count("*").alias("deleted"))
    known = completed_runs(runs).select("run_id")
    return known.join(states, "run_id", "left").join(gone, "run_id", "left").na.fill(0)


# When a page is read by recognition.
MIN_CHARS, MIN_WORDS, LARGEST_IMAGE, TOTAL_IMAGE = 80, 12, 0.55, 0.70


def page_route(chars: Column, words: Column, total: Column, largest: Column) -> Column:
    """struct<method, reason> of a page from its text and image shares."""
    def way(method: str, reason: str) -> Column:
        return F.struct(F.lit(method).alias("method"), F.lit(reason).alias("reason"))

    return (
        F.when((largest >= LARGEST_IMAGE) | (total >= TOTAL_IMAGE), way("ocr", "image_dominant"))
        .when((chars >= MIN_CHARS) | (words >= MIN_WORDS), way("pymupdf", "embedded_text"))
        .otherwise(way("ocr", "insufficient_text"))
    )


def image_shares(areas: Column, page_area: Column) -> Column:
    """struct<total, largest> of image areas in a page, each at most 1."""
    some = page_area > 0
    total = F.aggregate(areas, F.lit(0.0), lambda a, x: a + x) / page_area
    return F.struct(
        F.when(some, F.least(total, F.lit(1.0))).otherwise(0.0).alias("total"),
        F.when(some, F.coalesce(F.least(F.array_max(areas) / page_area, F.lit(1.0)), F.lit(0.0))).otherwise(0.0).alias("largest"),
    )
