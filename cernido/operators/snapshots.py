"""Full snapshots of a source: chains of runs, content versions, signed-cell diff.

A chain is the completed runs of one (user_id, source_type, source_scope_key),
ordered by ``snapshot_completed_at``, then ``run_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cernido.tables import blank_to_null, bounded_broadcast, latest

CHAIN = ["user_id", "source_type", "source_scope_key"]


def content_version(checksum: str = "checksum_sha256", revision: str = "revision_key") -> Column:
    """What the record holds: checksum, else revision key (without ``sha256:``).

    Blank counts as missing; letter case and surrounding blanks are no
    difference; null where the content is unknown.
    """
    key = F.lower(blank_to_null(F.col(revision)))
    return F.coalesce(F.lower(blank_to_null(F.col(checksum))), blank_to_null(F.regexp_replace(key, r"^sha256:", "")))


def completed_runs(runs: DataFrame) -> DataFrame:
    """(run_id, chain columns, completed_at, seq, next_run_id, prior_run_id) of completed runs.

    A run is completed if any of its rows has ``snapshot_completed_at``. ``seq``
    counts the runs of a chain from 1. An empty table gives an empty one.
    """
    per_run = runs.groupBy("run_id").agg(
        *[F.max(c).alias(c) for c in CHAIN], F.max("snapshot_completed_at").alias("completed_at")
    )
    order = Window.partitionBy(*CHAIN).orderBy("completed_at", "run_id")
    return (
        per_run.filter(F.col("completed_at").isNotNull())
        .withColumn("seq", F.row_number().over(order))
        .withColumn("prior_run_id", F.lag("run_id").over(order))
        .withColumn("next_run_id", F.lead("run_id").over(order))
    )


def listed_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """The files of completed runs with chain, seq and content; one row per file_id.

    The content is worked out before the rows are shuffled for the latest of each
    file. Runs are broadcast where they are counted to be few, else both sides
    are joined on run_id.
    """
    rows = latest(files.select("file_id", "run_id", "source_uri", content_version().alias("content"), "updated_at"), ["file_id"])
    known = completed_runs(runs)
    return rows.join(bounded_broadcast(known), "run_id").select("file_id", "source_uri", "content", *known.columns)


def signed_cells(rows: DataFrame, key: list[str], fields: list[str], sign: int | Column) -> DataFrame:
    """Unpivot: one (key, field, value, sign) cell per field, plus the cell that
    marks the key as present. A null value is unknown: its cell carries the
    sign in its value, so it never cancels against another."""
    mark = F.lit(sign) if isinstance(sign, int) else sign
    cells = [F.struct(F.lit("").alias("field"), F.lit("").alias("value"))] + [
        F.struct(
            F.lit(f).alias("field"),
            F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.concat(F.lit("?"), mark.cast("string"))).alias("value"),
        )
        for f in fields
    ]
    return rows.select(*key, mark.alias("sign"), F.explode(F.array(*cells)).alias("cell")).select(
        *key, "cell.field", "cell.value", "sign"
    )


def diff_cells(cells: DataFrame, key: list[str]) -> DataFrame:
    """(key, change_kind, changed_fields) of the keys whose cells don't cancel.

    The first sum finds the cells that differ, the second classifies the key:
    a presence of +1 was added, of -1 removed, otherwise it has changed. Both
    are combined before the shuffle, so a hot key costs one row a task.
    """
    left = cells.groupBy(*key, "field", "value").agg(F.sum("sign").alias("n")).filter("n <> 0")
    seen = F.sum(F.when(F.col("field") == "", F.col("n")).otherwise(0))
    return (
        left.groupBy(*key)
        .agg(seen.alias("presence"), F.array_sort(F.collect_set(F.when(F.col("field") != "", F.col("field")))).alias("changed_fields"))
        .select(
            *key,
            F.when(F.col("presence") > 0, "added").when(F.col("presence") < 0, "removed").otherwise("changed").alias("change_kind"),
            F.when(F.col("presence") == 0, F.col("changed_fields")).alias("changed_fields"),
        )
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """What changed between two full snapshots of a table.

    Null-safe on keys (a null key is a key). Repeated rows of a key count once
    a value: a key is present or not, and it has changed if its set of values
    has. Other columns, whatever their names, are ignored. Two empty snapshots
    give no rows.
    """
    def cells(df: DataFrame, sign: int) -> DataFrame:
        return signed_cells(df.select(*key, *fields).distinct(), key, fields, sign).distinct()

    return diff_cells(cells(after, 1).unionByName(cells(before, -1)), key)


def chain_diff(files: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, source_uri, change_kind, changed_fields) of each completed run
    but the first of its chain, against the completed run just before it.

    Each listing is read once and enters two comparisons: with sign +1 that of
    its own run, with sign -1 that of the next. A run that lists nothing removes
    all files of the one before.
    """
    listed = listed_files(files, runs)
    roles = F.array(
        F.struct(F.when(F.col("prior_run_id").isNotNull(), F.col("run_id")).alias("pair"), F.lit(1).alias("s")),
        F.struct(F.col("next_run_id").alias("pair"), F.lit(-1).alias("s")),
    )
    sided = listed.select("source_uri", "content", F.inline(roles)).filter("pair is not null")
    # hashed once on the key: unpivoting and both sums work within these partitions
    cells = signed_cells(sided.repartition("pair", "source_uri"), ["pair", "source_uri"], ["content"], F.col("s")).distinct()
    return diff_cells(cells, ["pair", "source_uri"]).withColumnRenamed("pair", "run_id")
