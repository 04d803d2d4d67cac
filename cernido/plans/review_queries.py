"""Queries of merges, reviews and measures, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cernido.operators import inventory, merging, review
from cernido.plans.reference_queries import _C, _E, _F, _P, _R, _REV, C_TABLE, E_TABLE, P_TABLE
from cernido.tables import latest, table


def _first(df: DataFrame, keys: list[str], order: str = "updated_at") -> DataFrame:
    """The earliest row of each key: what was stored before the later ones came."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("__n = 1").drop("__n")


ENTITY = ["file_id", "entity_id", "entity_index", "entity_type", "text", "score"]


def replaced_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities as first stored, those of files with scanned pages replaced by the
    later ones of a score of 0.9 or more."""
    entities, pages = table(spark, d, E_TABLE), latest(table(spark, d, P_TABLE), ["file_id", "page_number"])
    state = _first(entities.filter("updated_at is not null"), ["file_id", "entity_id"]).select(*ENTITY)
    new = latest(entities, ["file_id", "entity_id"]).filter("score >= 0.9").select(*ENTITY)
    order = [F.coalesce("entity_index", F.lit(10**9)), F.col("entity_id")]
    return merging.replace_by_file(state, new, pages.filter("method in ('ocr', 'both')"), order)


_REPLACED = f"""WITH {_E}, {_P}, o AS (SELECT * FROM {E_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, entity_id ORDER BY updated_at) = 1),
s AS (SELECT DISTINCT file_id FROM p WHERE method IN ('ocr', 'both'))
SELECT file_id, entity_id, entity_index, entity_type, text, score FROM o WHERE file_id NOT IN (SELECT file_id FROM s) UNION ALL
SELECT file_id, entity_id, row_number() OVER (PARTITION BY file_id ORDER BY coalesce(entity_index, 1000000000), entity_id) - 1, entity_type, text, score
FROM e WHERE score >= 0.9 AND file_id IN (SELECT file_id FROM s)"""

PAGE = ["file_id", "page_number", "method", "status", "reason", "char_count", "created_at"]


def upserted_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages as first stored with the later rows put in; the first reason and time of creation stay."""
    pages = table(spark, d, P_TABLE)
    key = ["file_id", "page_number"]
    return merging.upsert(_first(pages, key).select(*PAGE), latest(pages, key).select(*PAGE), key, ("reason", "created_at"))


_UPSERTED = f"""WITH {_P}, o AS (SELECT * FROM {P_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, page_number ORDER BY updated_at) = 1)
SELECT file_id, page_number, p.method, p.status, coalesce(o.reason, p.reason) AS reason, p.char_count, coalesce(o.created_at, p.created_at) AS created_at
FROM o JOIN p USING (file_id, page_number)"""

BOX = ["outbox_id", "delivery_no", "status", "attempts", "published_at"]


def merged_outbox(spark: SparkSession, d: str) -> DataFrame:
    """The outbox as first stored with the last delivery of each message put in."""
    box = table(spark, d, "queue_outbox")
    new = box.groupBy("outbox_id").agg(F.max(F.struct(*BOX[1:])).alias("o")).select("outbox_id", "o.*")
    old = box.groupBy("outbox_id").agg(F.min(F.struct(*BOX[1:])).alias("o")).select("outbox_id", "o.*")
    return merging.merge_outbox(old, new, "outbox_id")


_MERGED = """WITH o AS (SELECT * FROM queue_outbox QUALIFY row_number() OVER (PARTITION BY outbox_id ORDER BY delivery_no) = 1),
n AS (SELECT * FROM queue_outbox QUALIFY row_number() OVER (PARTITION BY outbox_id ORDER BY delivery_no DESC) = 1)
SELECT outbox_id, delivery_no, status, attempts, published_at FROM o WHERE published_at IS NOT NULL UNION ALL
SELECT n.outbox_id, n.delivery_no, n.status, n.attempts, n.published_at FROM n JOIN o USING (outbox_id) WHERE o.published_at IS NULL"""


def states_with_results(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot states where an earlier result serves again only if it is complete:
    all pages for texts, the last delivery published for tables."""
    files, runs, pages = table(spark, d, "files"), table(spark, d, "ingestion_runs"), table(spark, d, P_TABLE)
    route = inventory.route(F.col("extension"), F.col("mime_type"))
    rows = latest(files, ["file_id"]).select("file_id", route.alias("r"))
    done = latest(pages, ["file_id", "page_number"]).groupBy("file_id").agg(F.min(F.col("status") == "completed").alias("all"))
    text = F.when(F.col("all"), "text_extraction_completed")
    named = latest(table(spark, d, E_TABLE), ["file_id", "entity_id"]).select("file_id").distinct().withColumn("e", F.lit("entity_extraction_completed"))
    sent = table(spark, d, "queue_outbox").groupBy("file_id").agg(F.max("published_at").alias("at"))
    known = rows.join(done, "file_id", "left").join(named, "file_id", "left").join(sent, "file_id", "left")
    served = F.when(F.col("at").isNotNull(), "table_profile_completed")
    results = known.select("file_id", inventory.reusable(F.col("r.route_type"), F.col("r.route_status"), text, served, F.col("e")).alias("reusable"))
    return inventory.snapshot_states(files, runs, results).groupBy("run_id", "state").agg(F.count("*").alias("n"))


_WITH_RESULTS = f"""WITH {_F}, {_R}, {_P}, {_E}, rt AS (SELECT file_id, CASE WHEN e IN ('.pdf', '.png', '.jpg', '.jpeg', '.tif', '.tiff', '.bmp', '.webp', '.txt', '.docx') THEN 'text'
    WHEN e IN ('.csv', '.xlsx', '.xlsm') THEN 'table' WHEN e <> '' AND m NOT LIKE 'application/vnd.google-apps.%' THEN 'none'
    WHEN m = 'application/pdf' OR m LIKE 'image/%' OR m IN ('application/vnd.google-apps.document', 'application/vnd.google-apps.presentation', 'text/plain',
      'application/vnd.openxmlformats-officedocument.wordprocessingml.document') THEN 'text'
    WHEN m IN ('application/vnd.google-apps.spreadsheet', 'text/csv', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet',
      'application/vnd.ms-excel.sheet.macroenabled.12') THEN 'table' ELSE 'none' END AS route
  FROM (SELECT file_id, lower(trim(coalesce(mime_type, ''))) AS m, CASE WHEN lower(trim(coalesce(mime_type, ''))) LIKE 'application/vnd.google-apps.%' THEN ''
    WHEN trim(coalesce(extension, '')) = '' THEN '' WHEN extension LIKE '.%' THEN lower(trim(extension)) ELSE '.' || lower(trim(extension)) END AS e FROM f)),
pg AS (SELECT file_id, bool_and(status = 'completed') AS done FROM p GROUP BY 1), ob AS (SELECT file_id, max(published_at) AS sent_at FROM queue_outbox GROUP BY 1),
en AS (SELECT DISTINCT file_id FROM e),
ok AS (SELECT rt.file_id, CASE route WHEN 'text' THEN coalesce(done, false) AND en.file_id IS NOT NULL WHEN 'table' THEN sent_at IS NOT NULL ELSE true END AS reusable
  FROM rt LEFT JOIN pg USING (file_id) LEFT JOIN ob USING (file_id) LEFT JOIN en ON en.file_id = rt.file_id),
x AS (SELECT f.file_id, f.source_uri, r.*, {_REV} AS revision FROM f JOIN r USING (run_id)),
y AS (SELECT *, lag(file_id) OVER w AS prev, lag(revision) OVER w AS prev_revision FROM x WINDOW w AS (PARTITION BY user_id, source_type, source_scope_key, source_uri ORDER BY seq, file_id))
SELECT run_id, CASE WHEN prev IS NULL THEN 'new' WHEN revision IS NULL OR prev_revision IS NULL OR revision <> prev_revision THEN 'modified' WHEN NOT reusable THEN 'reprocessed' ELSE 'reused' END AS state,
  count(*) AS n FROM y LEFT JOIN ok ON ok.file_id = y.prev GROUP BY ALL"""


def recent_files(spark, d):
    return review.recent_files(table(spark, d, "files"), table(spark, d, P_TABLE))


_RECENT = f"""WITH {_F}, {_P} SELECT file_id, file_name, f.updated_at, total, completed FROM f JOIN (SELECT file_id, count(*) AS total, count(*) FILTER (status = 'completed') AS completed FROM p GROUP BY 1)
USING (file_id) ORDER BY updated_at DESC, file_name, file_id LIMIT 50"""


def guarded_delivery(spark, d):
    return review.guarded_delivery(table(spark, d, "files"), table(spark, d, "queue_outbox"))


_GUARDED = f"""WITH {_F}, o AS (SELECT file_id, run_id AS of_run, status FROM queue_outbox QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY created_at DESC, delivery_no DESC) = 1)
SELECT f.file_id, f.run_id, CASE WHEN of_run = f.run_id THEN o.status END AS delivered FROM f LEFT JOIN o USING (file_id)"""


def file_overview(spark, d):
    return review.file_overview(*[table(spark, d, t) for t in ("files", "queue_outbox", P_TABLE, C_TABLE, E_TABLE)])


_OVERVIEW = f"""WITH {_F}, {_P}, {_C}, {_E} SELECT f.file_id,
  (SELECT status FROM queue_outbox o WHERE o.file_id = f.file_id AND queue_name <> 'Queue-Tables' ORDER BY created_at DESC, delivery_no DESC LIMIT 1) AS text_status,
  (SELECT status FROM queue_outbox o WHERE o.file_id = f.file_id AND queue_name = 'Queue-Tables' ORDER BY created_at DESC, delivery_no DESC LIMIT 1) AS table_status,
  (SELECT CASE WHEN count(*) = 0 THEN NULL WHEN count(*) FILTER (status IN ('failed', 'quarantined')) > 0 THEN 'failed'
     WHEN count(*) FILTER (status = 'completed') < count(*) THEN 'waiting' ELSE 'completed' END FROM p WHERE p.file_id = f.file_id) AS file_status,
  (SELECT count(*) FROM c WHERE c.file_id = f.file_id) AS chunks, (SELECT count(*) FROM e WHERE e.file_id = f.file_id) AS entities FROM f"""


def active_elsewhere(spark, d):
    return review.active_elsewhere(table(spark, d, "ingestion_runs"))


_ACTIVE = """WITH r AS (SELECT run_id, user_id, source_type, source_scope_key, max(finished_at) AS finished FROM ingestion_runs GROUP BY ALL)
SELECT run_id FROM r WHERE EXISTS (SELECT 1 FROM r o WHERE o.user_id = r.user_id AND o.source_type = r.source_type AND o.source_scope_key = r.source_scope_key
  AND o.finished IS NULL AND o.run_id <> r.run_id)"""


def column_rows(spark, d):
    """Columns of the relations that are selected, here those of scopes written in capitals."""
    files = table(spark, d, "files").select(F.col("source_type").alias("schema_name"), F.col("extension").alias("table_name"), "file_id").distinct()
    wanted = table(spark, d, "files").filter("extension like '%x'").select(F.upper("source_type").alias("schema_name"), F.upper("extension").alias("table_name"))
    return review.column_rows(files, wanted)


_COLUMNS = """SELECT DISTINCT source_type AS schema_name, extension AS table_name, file_id FROM files a
WHERE EXISTS (SELECT 1 FROM files b WHERE b.extension LIKE '%x' AND lower(b.source_type) = lower(a.source_type) AND lower(b.extension) = lower(coalesce(a.extension, '')))"""


def chunk_listing(spark, d):
    return review.chunk_listing(table(spark, d, C_TABLE))


_CHUNKS = f"WITH {_C} SELECT file_id, chunk_id, row_number() OVER (PARTITION BY file_id ORDER BY page_start NULLS FIRST, chunk_index NULLS FIRST, chunk_id) AS place, left(text, 80) AS preview FROM c"


def ready_chunks(spark, d):
    return review.ready_chunks(table(spark, d, C_TABLE))


_READY = f"WITH {_C} SELECT file_id, chunk_id, row_number() OVER (PARTITION BY file_id ORDER BY chunk_index NULLS FIRST, chunk_id) AS ordinal FROM c WHERE status = 'ready'"


def newest_first(spark, d):
    return review.newest_first(table(spark, d, "files"))


_NEWEST = f"WITH {_F} SELECT run_id, file_id, row_number() OVER (PARTITION BY run_id ORDER BY updated_at DESC, file_id) AS ordinal FROM f"


def page_measures(spark, d):
    return review.page_measures(table(spark, d, P_TABLE))


_MEASURES = f"""WITH {_P}, x AS (SELECT file_id, round(coalesce(sum(greatest((epoch_us(updated_at) - epoch_us(created_at)) / 1e6, 0)), 0), 6) AS seconds,
  round(coalesce(greatest((max(epoch_us(updated_at)) FILTER (method IN ('ocr', 'both')) - min(epoch_us(created_at)) FILTER (method IN ('ocr', 'both'))) / 1e6, 0), 0), 6) AS wall,
  count(*) FILTER (method IN ('ocr', 'both')) AS n FROM p GROUP BY 1)
SELECT file_id, seconds, wall, round(wall / greatest(n, 1), 6) AS share FROM x"""


def chunk_pages(spark, d):
    return review.chunk_pages(table(spark, d, C_TABLE))


_PAGES = f"""WITH {_C} SELECT file_id, min(page_start) AS first_page, max(page_end) AS last_page,
  (list(method ORDER BY page_start, chunk_index, chunk_id) FILTER (method IS NOT NULL))[1] AS method, array_to_string(list_sort(list(DISTINCT page_start)), ',') AS pages FROM c GROUP BY 1"""


def text_counts(spark, d):
    """Characters and words of every chunk and document."""
    both = table(spark, d, C_TABLE).select(F.col("chunk_id").alias("id"), "text").unionByName(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text"))
    chars, words = review.text_counts(F.col("text"))
    return both.select("id", chars.alias("chars"), words.cast("long").alias("words"))


_COUNTS = r"""SELECT id, coalesce(length(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), 0) AS chars, coalesce(len(regexp_extract_all(text, '[^ \t\n\r\f\v]+')), 0) AS words
FROM (SELECT chunk_id AS id, text FROM text_chunks_staging UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents)"""


def uuid5_ids(spark, d):
    """Name-based ids of all file uris."""
    return table(spark, d, "files").select("source_uri").distinct().select("source_uri", review.uuid5(F.col("source_uri")).alias("id"))


_UUID = """WITH h AS (SELECT DISTINCT source_uri, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source_uri)) AS h FROM files)
SELECT source_uri, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || h[18:20] || '-' || h[21:32] AS id FROM h"""


def value_ratios(spark, d):
    """Name-like and textual shares of the text columns of three tables."""
    out = None
    for name, columns in (("customer", ["c_name", "c_mktsegment"]), ("part", ["p_name", "p_brand", "p_partkey"]), ("documents", ["lang", "source", "n_chars"])):
        part = review.value_ratios(table(spark, d, name), columns)
        out = part if out is None else out.unionByName(part)
    return out


_RATIOS = r"""WITH v AS (SELECT 'c_name' AS column_name, c_name AS x FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT 'p_name', p_name FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_partkey', CAST(p_partkey AS VARCHAR) FROM part UNION ALL SELECT 'lang', lang FROM documents
  UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM documents),
n AS (SELECT column_name, trim(x) AS x, trim(lower(regexp_replace(strip_accents(x), '[^A-Za-z0-9]+', ' ', 'g'))) AS k FROM v WHERE trim(x) <> '')
SELECT column_name, round(avg(CASE WHEN NOT regexp_matches(x, '[0-9]') AND len(string_split(k, ' ')) BETWEEN 2 AND 5 AND length(k) <= 80
  AND len(list_filter(string_split(k, ' '), lambda w: NOT regexp_full_match(w, '[a-z]{2,}'))) = 0 THEN 1 ELSE 0 END), 6) AS names,
  round(avg(CASE WHEN regexp_matches(x, '[A-Za-z]') THEN 1 ELSE 0 END), 6) AS textual FROM n GROUP BY 1"""

QUERIES = {
    "replaced_entities": (replaced_entities, _REPLACED),
    "upserted_pages": (upserted_pages, _UPSERTED),
    "merged_outbox": (merged_outbox, _MERGED),
    "states_with_results": (states_with_results, _WITH_RESULTS),
    "recent_files": (recent_files, _RECENT),
    "guarded_delivery": (guarded_delivery, _GUARDED),
    "file_overview": (file_overview, _OVERVIEW),
    "active_elsewhere": (active_elsewhere, _ACTIVE),
    "column_rows": (column_rows, _COLUMNS),
    "chunk_listing": (chunk_listing, _CHUNKS),
    "ready_chunks": (ready_chunks, _READY),
    "newest_first": (newest_first, _NEWEST),
    "page_measures": (page_measures, _MEASURES),
    "chunk_pages": (chunk_pages, _PAGES),
    "text_counts": (text_counts, _COUNTS),
    "uuid5_ids": (uuid5_ids, _UUID),
    "value_ratios": (value_ratios, _RATIOS),
}
