"""All registered core queries: name -> (callable, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cernido.plans import data_queries, finding_queries, reference_queries, review_queries, stream_queries

Query = tuple[Callable[[SparkSession, str], DataFrame], "str | None"]


def core() -> dict[str, Query]:
    return {**data_queries.QUERIES, **reference_queries.QUERIES, **review_queries.QUERIES, **finding_queries.QUERIES, **stream_queries.QUERIES}
