"""Queries of the core data problems (new or changed records, snapshot
differences, repeated deliveries) and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cernido.operators.delivery import kept_copies, new_messages, repeated_deliveries
from cernido.operators.incremental import TargetState, publish_in_waves, replay_new_or_changed
from cernido.operators.snapshots import chain_diff
from cernido.tables import scratch_path, table

_LISTED = r"""
WITH f AS (
  SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY updated_at DESC) = 1
), r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, source_type, source_scope_key ORDER BY done, run_id) AS seq,
         lag(run_id) OVER (PARTITION BY user_id, source_type, source_scope_key ORDER BY done, run_id) AS prior
  FROM (SELECT run_id, max(user_id) AS user_id, max(source_type) AS source_type,
               max(source_scope_key) AS source_scope_key, max(snapshot_completed_at) AS done
        FROM ingestion_runs GROUP BY run_id)
  WHERE done IS NOT NULL
), listed AS (
  SELECT f.file_id, f.source_uri, r.*,
         coalesce(nullif(regexp_replace(lower(checksum_sha256), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), ''),
                  nullif(regexp_replace(regexp_replace(lower(revision_key), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '^sha256:', ''), '')) AS content
  FROM f JOIN r USING (run_id)
)
"""


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Files that each completed run must process as new or changed."""
    return replay_new_or_changed(table(spark, d, "files"), table(spark, d, "ingestion_runs")).select("file_id").distinct()


def p2_by_run(spark: SparkSession, d: str) -> DataFrame:
    """How many files each completed run must process."""
    todo = replay_new_or_changed(table(spark, d, "files"), table(spark, d, "ingestion_runs"))
    return todo.groupBy("run_id").agg(F.count("*").alias("pending_files"))


def p2_published(spark: SparkSession, d: str) -> DataFrame:
    """What the target holds after all completed runs went through it in waves."""
    target = TargetState(spark, scratch_path(spark, "published"))
    return publish_in_waves(table(spark, d, "files"), table(spark, d, "ingestion_runs"), target)


_PUBLISHED = _LISTED + """SELECT user_id, source_type, source_scope_key, source_uri, content FROM listed
QUALIFY row_number() OVER (PARTITION BY user_id, source_type, source_scope_key, source_uri ORDER BY seq DESC, content DESC NULLS LAST) = 1"""

_P2 = _LISTED + """, x AS (
  SELECT run_id, file_id, content, lag(file_id) OVER w AS prior_file, lag(content) OVER w AS prior_content FROM listed
  WINDOW w AS (PARTITION BY user_id, source_type, source_scope_key, source_uri ORDER BY seq)
), found AS (
  SELECT run_id, file_id FROM x
  WHERE prior_file IS NULL OR content IS NULL OR prior_content IS NULL OR content <> prior_content
)
"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Files added, removed or changed between consecutive completed snapshots."""
    diff = chain_diff(table(spark, d, "files"), table(spark, d, "ingestion_runs"))
    return diff.select("run_id", "source_uri", "change_kind")


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """Changes of each kind by run."""
    return p5_found(spark, d).groupBy("run_id", "change_kind").agg(F.count("*").alias("changes"))


_P5 = _LISTED + """, found AS (
  SELECT coalesce(c.run_id, p.run_id) AS run_id, coalesce(c.source_uri, p.source_uri) AS source_uri,
         CASE WHEN p.run_id IS NULL THEN 'added' WHEN c.run_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
  FROM (SELECT run_id, source_uri, content FROM listed WHERE prior IS NOT NULL) c
  FULL JOIN (SELECT n.run_id, l.source_uri, l.content FROM r n JOIN listed l ON n.prior = l.run_id) p
    ON c.run_id = p.run_id AND c.source_uri = p.source_uri
  WHERE p.run_id IS NULL OR c.run_id IS NULL OR c.content IS NULL OR p.content IS NULL OR c.content <> p.content
)
"""


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Every delivery except the kept one of its message."""
    return repeated_deliveries(table(spark, d, "queue_outbox"))


def p7_messages(spark: SparkSession, d: str) -> DataFrame:
    """One row per message: the kept delivery, with all its columns."""
    outbox = table(spark, d, "queue_outbox")
    return outbox.join(kept_copies(outbox).select("delivery_no"), "delivery_no", "left_semi")


def p7_new_messages(spark: SparkSession, d: str) -> DataFrame:
    """The messages that the last batch brings and no earlier one has."""
    outbox = table(spark, d, "queue_outbox")
    last = outbox.agg(F.max("batch_no")).first()[0]
    return new_messages(outbox.filter(F.col("batch_no") == last), outbox.filter(F.col("batch_no") < last)).select("delivery_no")


_P7 = r"""
WITH RECURSIVE n AS (
  SELECT delivery_no, batch_no, published_at,
         nullif(regexp_replace(lower(idempotency_key), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') AS k,
         coalesce(queue_name, '') || chr(1) || nullif(regexp_replace(pubsub_message_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') AS p
  FROM queue_outbox
), e AS (
  SELECT DISTINCT 'k' || k AS a, 'p' || p AS b FROM n WHERE k IS NOT NULL AND p IS NOT NULL
), edges AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
walk AS (
  SELECT a AS node, a AS root FROM edges
  UNION
  SELECT edges.b, walk.root FROM walk JOIN edges ON edges.a = walk.node
), roots AS (SELECT node, min(root) AS root FROM walk GROUP BY node),
m AS (
  SELECT n.*, coalesce(rk.root, rp.root, 'p' || n.p, 'k' || n.k, 'd' || n.delivery_no) AS message
  FROM n LEFT JOIN roots rk ON rk.node = 'k' || n.k LEFT JOIN roots rp ON rp.node = 'p' || n.p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY message ORDER BY published_at IS NULL, published_at, delivery_no) AS rank FROM m
)
"""

QUERIES = {
    "p2_found": (p2_found, _P2 + "SELECT DISTINCT file_id FROM found"),
    "p2_by_run": (p2_by_run, _P2 + "SELECT run_id, count(*) AS pending_files FROM found GROUP BY run_id"),
    "p2_published": (p2_published, _PUBLISHED),
    "p5_found": (p5_found, _P5 + "SELECT * FROM found"),
    "p5_counts": (p5_counts, _P5 + "SELECT run_id, change_kind, count(*) AS changes FROM found GROUP BY ALL"),
    "p7_found": (p7_found, _P7 + "SELECT delivery_no FROM ranked WHERE rank > 1"),
    "p7_messages": (
        p7_messages,
        _P7 + "SELECT q.* FROM queue_outbox q JOIN (SELECT delivery_no FROM ranked WHERE rank = 1) USING (delivery_no)",
    ),
    "p7_new_messages": (
        p7_new_messages,
        _P7 + "SELECT min(delivery_no) FILTER (rank = 1) AS delivery_no FROM ranked GROUP BY message HAVING min(batch_no) = (SELECT max(batch_no) FROM queue_outbox)",
    ),
}
