"""Bringing new rows into a stored table: replace by file, upsert, outbox merge.

All give the new content of the table as a frame, to be published by
``incremental.TargetState`` or written over a partition; each shuffles both
sides once on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def replace_by_file(state: DataFrame, new: DataFrame, files: DataFrame, order: list[Column], index: str = "entity_index") -> DataFrame:
    """``state`` with all rows of ``files`` (file_id) replaced by those of ``new``,
    also where these hold none of a file; ``index`` counts a file's new rows from
    0 in ``order``. Rows of ``new`` of other files are left out. Columns are
    those of ``state``."""
    done = files.select("file_id").distinct()
    place = F.row_number().over(Window.partitionBy("file_id").orderBy(*order)) - 1
    made = new.join(done, "file_id", "left_semi").withColumn(index, place)
    return state.join(done, "file_id", "left_anti").unionByName(made.select(*state.columns))


def upsert(state: DataFrame, new: DataFrame, key: list[str], keep_first: tuple[str, ...] = ()) -> DataFrame:
    """``state`` with the rows of ``new`` put in by key (unique on each side, compared
    null-safe). The columns of ``keep_first`` keep their first value that isn't
    null, the others take that of the new row, null included."""
    s, n = state.alias("s"), new.withColumn("__in", F.lit(True)).alias("n")
    both = s.join(n, [F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in key], "full")
    is_new = F.coalesce(F.col("n.__in"), F.lit(False))

    def value(c: str) -> Column:
        if c in key or c in keep_first:
            return F.coalesce(F.col(f"s.{c}"), F.col(f"n.{c}")).alias(c)
        return F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c)

    return both.select([value(c) for c in state.columns])


def merge_outbox(state: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``state`` with the messages of ``new`` put in by key (unique on each side): a
    message that is published stays as it is, any other is replaced."""
    published = state.filter("published_at is not null").select(key)
    taken = new.join(published, key, "left_anti")
    return state.join(taken.select(key), key, "left_anti").select(*state.columns).unionByName(taken.select(*state.columns))
