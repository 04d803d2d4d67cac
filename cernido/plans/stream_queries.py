"""Queries over message streams and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cernido.streaming.messages import completed_files, dead_letters, drain, judged, read_stream
from cernido.tables import latest, scratch_path, table


def _spoiled(spark: SparkSession, d: str) -> DataFrame:
    """All deliveries, some with a payload spoiled in each way that the contract rules out."""
    n = F.col("delivery_no") % 11
    payload = (
        F.when(n == 1, "not json").when(n == 2, F.replace("payload", F.lit("file.routed"), F.lit("file.lost"))).when(n == 3, F.lit('{"event_type": "file.routed", "attempt": 1}'))
        .when(n == 4, F.lit('{"event_type": "file.routed", "file_id": "other", "attempt": 1}')).when(n == 5, F.regexp_replace("payload", '"attempt": \\d+', '"attempt": 0'))
        .otherwise(F.col("payload"))
    )
    return table(spark, d, "queue_outbox").withColumn("payload", payload)


def contract_problems(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries by contract problem."""
    return judged(_spoiled(spark, d)).groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count("*").alias("n"))


_JUDGED = r"""WITH s AS (SELECT * REPLACE (CASE delivery_no % 11 WHEN 1 THEN 'not json' WHEN 2 THEN replace(payload, 'file.routed', 'file.lost') WHEN 3 THEN '{"event_type": "file.routed", "attempt": 1}'
    WHEN 4 THEN '{"event_type": "file.routed", "file_id": "other", "attempt": 1}' WHEN 5 THEN regexp_replace(payload, '"attempt": \d+', '"attempt": 0') ELSE payload END AS payload) FROM queue_outbox),
x AS (SELECT *, CASE WHEN json_valid(payload) THEN payload ->> '$.event_type' END AS ev, CASE WHEN json_valid(payload) THEN payload ->> '$.file_id' END AS fi,
  CASE WHEN json_valid(payload) THEN CAST(payload ->> '$.attempt' AS INT) END AS att FROM s),
j AS (SELECT *, CASE WHEN ev IS NULL AND fi IS NULL AND att IS NULL THEN 'malformed_payload' WHEN ev IS NULL OR ev NOT IN ('file.routed', 'file.chunks_ready') THEN 'unknown_event'
  WHEN coalesce(fi, '') = '' THEN 'missing_file_id' WHEN fi <> file_id THEN 'file_mismatch' WHEN coalesce(att, 0) < 1 THEN 'bad_attempt' END AS problem FROM x)"""


def poison(spark: SparkSession, d: str) -> DataFrame:
    return dead_letters(_spoiled(spark, d))


def stream_drain(spark: SparkSession, d: str) -> DataFrame:
    """Events drained once from a stream of files, counted by type."""
    schema = table(spark, d, "events").schema
    work = scratch_path(spark, "drain")
    stream = read_stream(spark, f"{d}/events*.parquet", schema)
    drain(stream, f"{work}/out", f"{work}/state", "event_id").awaitTermination()
    rows = spark.read.parquet(f"{work}/out")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


def complete_files(spark: SparkSession, d: str) -> DataFrame:
    return completed_files(latest(table(spark, d, "text_extraction_pages"), ["file_id", "page_number"]))


QUERIES = {
    "contract_problems": (contract_problems, _JUDGED + " SELECT coalesce(problem, 'none') AS problem, count(*) AS n FROM j GROUP BY 1"),
    "poison": (
        poison,
        _JUDGED + " SELECT 'poison:' || coalesce(run_id, '') || ':' || coalesce(file_id, '') || ':' || problem AS dead_letter_key, min(problem) AS problem,"
        " count(*) AS deliveries FROM j WHERE problem IS NOT NULL GROUP BY 1",
    ),
    "stream_drain": (stream_drain, "SELECT event_type, count(DISTINCT event_id) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1"),
    "complete_files": (
        complete_files,
        "WITH p AS (SELECT * FROM text_extraction_pages QUALIFY row_number() OVER (PARTITION BY file_id, page_number ORDER BY updated_at DESC) = 1)"
        " SELECT file_id, count(*) AS pages FROM p GROUP BY 1 HAVING count(*) FILTER (status <> 'completed' OR status IS NULL) = 0",
    ),
}
