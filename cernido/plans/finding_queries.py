"""Queries of the levels, scores and propagation of column findings, over match
rates counted from the part table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cernido.functions import validators as v
from cernido.operators import discovery, reporting
from cernido.plans.reference_queries import _TYPE_ROWS, _list
from cernido.tables import table

NAMES = [
    "rut", "correo", "fono_casa", "fecha_nacimiento", "created_date", "sexo", "isapre", "afp", "religion", "monto", "direccion", "usuario", "tarjeta", "nombre",
    "orientacion", "patente", "codigo",
]
CHECKS = [*discovery.VALUE_CHECKED, "TEXT_DATE", "ADDRESS_VALUE"]


def _context_and_rates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """One table a brand, with columns of telling and of plain names; how many of
    a brand's parts pass a check is worked out from their keys."""
    parts = table(spark, d, "part")
    brands = sorted(r[0] for r in parts.select("p_brand").distinct().collect())
    profiles = [discovery.ColumnProfile(b, c, "date" if i % 3 == 0 else "string", i + 1) for b in brands for i, c in enumerate(NAMES)]
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name")) for i, c in enumerate(NAMES)])
    checks = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(c).alias("entity_type")) for j, c in enumerate(CHECKS)])
    rows = parts.select(F.col("p_brand").alias("table_name"), "p_partkey", F.inline(each)).select("*", F.inline(checks))
    passes = (F.col("p_partkey") * (F.col("i") + 2) + F.col("j") * 5) % 7 < (F.col("i") * 3 + F.col("j") + F.length("table_name")) % 9
    # tables of brands that end in 5 hold no values
    some = ~F.endswith("table_name", F.lit("5"))
    rates = rows.groupBy("table_name", "column_name", "entity_type").agg(F.count_if(passes & some).alias("matched"), F.count_if(some).alias("sampled"))
    return discovery.contexts(spark, profiles), rates


SHOWN = ["table_name", "column_name", "pii_type", "confidence", "confidence_level", "detection_method", "sampled", "matched"]


def finding_levels(spark: SparkSession, d: str) -> DataFrame:
    """The best finding of each column."""
    return discovery.direct_findings(*_context_and_rates(spark, d)).select(*SHOWN)


def finding_summary(spark: SparkSession, d: str) -> DataFrame:
    return reporting.findings_summary(discovery.direct_findings(*_context_and_rates(spark, d)))


def finding_projection(spark: SparkSession, d: str) -> DataFrame:
    return reporting.findings_projection(discovery.direct_findings(*_context_and_rates(spark, d)))


def finding_tables(spark: SparkSession, d: str) -> DataFrame:
    """Findings of a level above PROBABLE by table, zero where there are none."""
    context, rates = _context_and_rates(spark, d)
    tables = sorted(r[0] for r in context.select("table_name").distinct().collect())
    return reporting.findings_per_table(tables, discovery.direct_findings(context, rates).filter("confidence_level <> 'PROBABLE'"))


def passed_on_findings(spark: SparkSession, d: str) -> DataFrame:
    """Findings passed on to columns of the same name."""
    context, rates = _context_and_rates(spark, d)
    return discovery.propagate_by_name(context, discovery.direct_findings(context, rates)).select(*SHOWN, "propagated_from")


_NAME_ROWS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(NAMES))
_CHECK_ROWS = ", ".join(f"({j}, '{c}')" for j, c in enumerate(CHECKS))
_FOUND = f"""WITH n(i, column_name) AS (VALUES {_NAME_ROWS}), k(j, entity_type) AS (VALUES {_CHECK_ROWS}), t(kind, tokens, phrases) AS (VALUES {_TYPE_ROWS}),
r AS (SELECT p_brand AS table_name, i, column_name, entity_type, count(*) FILTER ((p_partkey * (i + 2) + j * 5) % 7 < (i * 3 + j + length(p_brand)) % 9 AND p_brand NOT LIKE '%5') AS matched,
  count(*) FILTER (p_brand NOT LIKE '%5') AS sampled FROM part CROSS JOIN n CROSS JOIN k GROUP BY ALL),
c AS (SELECT *, CASE WHEN sampled > 0 THEN matched / sampled ELSE 0 END AS rate, i % 3 = 0 AS date_type, list_has_any(string_split(column_name, '_'), {_list(discovery.NOT_BIRTH_WORDS)}) AS not_birth,
  (SELECT list(kind) FROM t WHERE list_contains(phrases, column_name) OR list_has_any(tokens, string_split(column_name, '_'))) AS types,
  entity_type IN ({", ".join(f"'{x}'" for x in v.CATALOGS)}) AS catalog FROM r),
o AS (SELECT *, coalesce(list_contains(types, entity_type), false) AS told FROM c),
every AS (
  SELECT 0 AS stage, table_name, i, column_name, entity_type AS pii_type, matched, sampled, rate, CASE WHEN matched = 0 THEN 'header_only' WHEN told THEN 'header_and_value' ELSE 'value_validator' END AS detection_method,
    CASE WHEN matched = 0 THEN CASE WHEN told AND NOT (entity_type = 'DATE' AND sampled > 0) THEN 'PROBABLE' END
      WHEN entity_type = 'DATE' THEN CASE WHEN not_birth AND NOT told THEN NULL WHEN rate >= 0.85 THEN CASE WHEN told THEN 'VERY_CONFIDENT' WHEN date_type THEN 'CONFIDENT' ELSE 'PROBABLE' END
        WHEN told AND rate >= 0.5 THEN 'CONFIDENT' WHEN told THEN 'PROBABLE' END
      WHEN rate >= 0.85 THEN CASE WHEN catalog AND NOT told AND matched < 3 THEN 'CONFIDENT' ELSE 'VERY_CONFIDENT' END
      WHEN rate >= 0.5 AND matched >= 2 THEN 'CONFIDENT' WHEN told THEN 'PROBABLE' WHEN matched = sampled AND NOT catalog THEN 'PROBABLE' END AS confidence_level
  FROM o WHERE entity_type NOT IN ('TEXT_DATE', 'ADDRESS_VALUE')
  UNION ALL SELECT 1, table_name, i, column_name, 'ONLINE_IDENTIFIER', 0, sampled, 0, 'header_online_identifier', 'PROBABLE' FROM o WHERE entity_type = 'RUT' AND list_contains(types, 'ONLINE_IDENTIFIER')
  UNION ALL SELECT 2, table_name, i, column_name, 'DATE', matched, sampled, rate, 'text_date_validator', CASE WHEN rate >= 0.85 THEN 'VERY_CONFIDENT' WHEN rate >= 0.5 THEN 'CONFIDENT' ELSE 'PROBABLE' END
    FROM o WHERE entity_type = 'TEXT_DATE' AND list_contains(types, 'DATE') AND NOT not_birth AND matched > 0
  UNION ALL SELECT 3, table_name, i, column_name, 'ADDRESS', matched, sampled, rate, 'address_heuristic', CASE WHEN list_contains(types, 'ADDRESS') AND rate >= 0.65 THEN 'CONFIDENT'
    WHEN coalesce(list_contains(types, 'ADDRESS'), false) OR rate >= 0.5 THEN 'PROBABLE' END FROM o WHERE entity_type = 'ADDRESS_VALUE' AND matched > 0),
best AS (SELECT * FROM every WHERE confidence_level IS NOT NULL QUALIFY row_number() OVER (PARTITION BY table_name, i ORDER BY stage, CASE confidence_level WHEN 'VERY_CONFIDENT' THEN 3 WHEN 'CONFIDENT' THEN 2 ELSE 1 END DESC,
  rate DESC, matched DESC, list_position({_list(discovery.ENTITY_ORDER)}, pii_type)) = 1),
found AS (SELECT table_name, i, column_name, pii_type, round(CASE confidence_level WHEN 'VERY_CONFIDENT' THEN least(0.99, 0.95 + greatest(0, rate - 0.85) * 0.1)
  WHEN 'CONFIDENT' THEN least(0.89, 0.75 + rate * 0.1) ELSE least(0.69, 0.55 + rate * 0.1) END, 4) AS confidence, confidence_level, detection_method, sampled, matched FROM best)
"""
_SHOWN = ", ".join(SHOWN)
_PASSED = (
    _FOUND
    + f""", first AS (SELECT * FROM found WHERE NOT list_contains({_list(discovery.GENERIC_WORDS)}, column_name) QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY table_name, i) = 1)
SELECT a.table_name, a.column_name, s.pii_type, CASE WHEN s.confidence_level = 'PROBABLE' THEN 0.55 ELSE 0.75 END AS confidence, CASE WHEN s.confidence_level = 'PROBABLE' THEN 'PROBABLE' ELSE 'CONFIDENT' END AS confidence_level,
  'propagated_column_name' AS detection_method, 0 AS sampled, 0 AS matched, s.table_name || '.' || s.column_name AS propagated_from
FROM (SELECT DISTINCT p_brand AS table_name, i, column_name FROM part CROSS JOIN n) a JOIN first s USING (column_name) LEFT JOIN found h ON h.table_name = a.table_name AND h.i = a.i
WHERE (h.confidence_level IS NULL OR h.confidence_level = 'PROBABLE') AND a.table_name <> s.table_name"""
)

QUERIES = {
    "finding_levels": (finding_levels, _FOUND + f"SELECT {_SHOWN} FROM found"),
    "finding_summary": (finding_summary, _FOUND + "SELECT pii_type, confidence_level, count(*) AS findings FROM found GROUP BY ALL"),
    "finding_projection": (
        finding_projection,
        _FOUND + "SELECT 0 AS schemas, count(DISTINCT table_name) AS tables, count(DISTINCT table_name || '.' || column_name) AS columns, count(DISTINCT pii_type) AS types, count(*) AS findings FROM found",
    ),
    "finding_tables": (
        finding_tables,
        _FOUND + "SELECT table_name, count(f.i) AS finding_count FROM (SELECT DISTINCT p_brand AS table_name FROM part) b LEFT JOIN (SELECT * FROM found WHERE confidence_level <> 'PROBABLE') f USING (table_name) GROUP BY 1",
    ),
    "passed_on_findings": (passed_on_findings, _PASSED),
}
