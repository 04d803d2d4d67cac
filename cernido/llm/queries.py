"""Registered queries on text: name -> (callable, SQL or None)."""

from __future__ import annotations

import os
import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cernido.llm.leakage import leaked, leaks_by_item
from cernido.llm.lookalike import canonical_entities, same_look_pairs
from cernido.llm.personal import found_mentions, replaced, surrogate_faults
from cernido.llm.scanned import found_noise, repaired
from cernido.llm.split import oversized, resplit
from cernido.llm.tokenize import encode_corpus
from cernido.llm.truncation import cut_texts, truncation_rates
from cernido.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The kinds of scanning noise in each chunk."""
    return found_noise(table(spark, d, "text_chunks_staging"), table(spark, d, "text_extraction_pages"))


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Scanned chunks as continuous paragraphs."""
    return repaired(table(spark, d, "text_chunks_staging"), table(spark, d, "text_extraction_pages"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of persons and their contact data."""
    return found_mentions(table(spark, d, "text_chunks_staging"), table(spark, d, "entity_extraction_entities"))


def p3_replaced(spark: SparkSession, d: str) -> DataFrame:
    """The same texts with a typed surrogate for each mention."""
    return replaced(table(spark, d, "text_chunks_staging"), table(spark, d, "entity_extraction_entities"), surrogate_key())


def p3_surrogates(spark: SparkSession, d: str) -> DataFrame:
    """Distinctness, avoidance of real values and format of all surrogates by type."""
    return surrogate_faults(table(spark, d, "text_chunks_staging"), table(spark, d, "entity_extraction_entities"), surrogate_key())


def surrogate_key() -> bytes:
    """The secret of the surrogates from CERNIDO_SURROGATE_KEY; without one a key of this run alone."""
    return os.environ.get("CERNIDO_SURROGATE_KEY", "").encode() or secrets.token_bytes(32)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Entities of one file that look the same and aren't the same string."""
    return same_look_pairs(table(spark, d, "entity_extraction_entities"))


def p4_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The one form of each entity's text."""
    return canonical_entities(table(spark, d, "entity_extraction_entities"))


def _chunks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, d, "text_chunks_staging"), table(spark, d, "text_extraction_pages"), table(spark, d, "chunk_limits")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that are longer than the limit of their method."""
    return oversized(*_chunks(spark, d)).select("chunk_id").distinct()


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All chunks within their limits, renumbered by file."""
    return resplit(*_chunks(spark, d))


_P6 = """
WITH c AS (
  SELECT * FROM text_chunks_staging QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY updated_at DESC) = 1
), p AS (
  SELECT * FROM text_extraction_pages
  QUALIFY row_number() OVER (PARTITION BY file_id, page_number ORDER BY updated_at DESC) = 1
)
SELECT DISTINCT c.chunk_id FROM c
LEFT JOIN p ON p.file_id = c.file_id AND p.page_number = c.page_start
JOIN chunk_limits l ON l.method = coalesce(c.method, p.method)
WHERE length(c.text) > l.max_chars
"""


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, d, "documents"))


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tokens by source: how large the corpus is for a trainer."""
    docs = table(spark, d, "documents")
    sizes = encode_corpus(docs).select("doc_id", F.size("ids").alias("n"))
    return (
        sizes.join(docs.select("doc_id", F.lower("source").alias("source")), "doc_id")
        .groupBy("source")
        .agg(F.sum("n").alias("tokens"), F.count("*").alias("documents"))
    )


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold passages of test items."""
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p9_by_item(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    return leaks_by_item(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text was cut."""
    return cut_texts(table(spark, d, "documents")).select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates."""
    return truncation_rates(table(spark, d, "documents"))


QUERIES = {
    "p1_found": (p1_found, None),
    "p1_repaired": (p1_repaired, None),
    "p3_found": (p3_found, None),
    "p3_replaced": (p3_replaced, None),
    "p3_surrogates": (p3_surrogates, None),
    "p4_found": (p4_found, None),
    "p4_canonical": (p4_canonical, None),
    "p6_found": (p6_found, _P6),
    "p6_pieces": (p6_pieces, None),
    "p8_ids": (p8_ids, None),
    "p8_counts": (p8_counts, None),
    "p9_found": (p9_found, None),
    "p9_by_item": (p9_by_item, None),
    "p10_found": (p10_found, None),
    "p10_rates": (p10_rates, None),
}
