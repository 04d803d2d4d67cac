"""Queries of the discovery pipeline's own operators and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cernido.functions import textnorm as tn
from cernido.functions import validators as v
from cernido.functions.spans import PATTERNS, TERMS, detect, pattern_spans, term_spans
from cernido.operators import chunking, discovery, inventory, reporting, resolution
from cernido.tables import latest, table

TODAY = "2026-01-01"
E_TABLE, C_TABLE, P_TABLE = "entity_extraction_entities", "text_chunks_staging", "text_extraction_pages"

_E = f"e AS (SELECT * FROM {E_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, entity_id ORDER BY updated_at DESC) = 1)"
_C = f"c AS (SELECT * FROM {C_TABLE} QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY updated_at DESC) = 1)"
_P = f"p AS (SELECT * FROM {P_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, page_number ORDER BY updated_at DESC) = 1)"
_F = "f AS (SELECT * FROM files QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY updated_at DESC) = 1)"
_R = """r AS (
  SELECT *, row_number() OVER w AS seq, lag(run_id) OVER w AS prior FROM (
    SELECT run_id, max(user_id) AS user_id, max(source_type) AS source_type, max(source_scope_key) AS source_scope_key,
           max(snapshot_completed_at) AS done FROM ingestion_runs GROUP BY run_id)
  WHERE done IS NOT NULL
  WINDOW w AS (PARTITION BY user_id, source_type, source_scope_key ORDER BY done, run_id))"""


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, E_TABLE), ["file_id", "entity_id"])


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, C_TABLE), ["chunk_id"]).select("file_id", "chunk_id", "chunk_index", "text")


# ---- normalizers and validators ---------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join(f"'{x}'" for x in values) + "]"


def norm_keys(spark, d):
    """Both key families and identifiers of file names."""
    c = F.col("file_name")
    return table(spark, d, "files").select(
        "file_id", "updated_at", tn.text_key(c).alias("text_key"), tn.tabular_key(c).alias("tabular_key"), tn.identifier(c).alias("identifier"),
        tn.masked(c).alias("masked"), tn.extension(F.col("extension")).alias("ext"), tn.digits_only(c).alias("digits"),
    ).distinct()


_NORM = r"""SELECT DISTINCT file_id, updated_at, lower(regexp_replace(trim(file_name), '\s+', ' ', 'g')) AS text_key,
  trim(lower(regexp_replace(strip_accents(file_name), '[^A-Za-z0-9]+', ' ', 'g'))) AS tabular_key,
  lower(trim(regexp_replace(strip_accents(file_name), '[^A-Za-z0-9]+', '_', 'g'), '_')) AS identifier,
  CASE WHEN length(file_name) <= 2 THEN repeat('*', length(file_name))
       ELSE left(file_name, 1) || repeat('*', length(file_name) - 2) || right(file_name, 1) END AS masked,
  CASE WHEN trim(coalesce(extension, '')) = '' THEN '' WHEN extension LIKE '.%' THEN lower(trim(extension)) ELSE '.' || lower(trim(extension)) END AS ext,
  regexp_replace(file_name, '[^0-9]', '', 'g') AS digits FROM files"""


def rut_values(spark, d):
    """National ids of all entities of that type: normalized or null."""
    return _entities(spark, d).filter("entity_type = 'RUT'").select("file_id", "entity_id", v.rut(F.col("text")).alias("rut"))


_RUT_OK = """(11 - list_sum(list_transform(range(length(b)), lambda i: CAST(substr(reverse(b), i + 1, 1) AS INT) * (2 + i % 6))) % 11)"""
_RUT = f"""WITH {_E}, x AS (
  SELECT file_id, entity_id, upper(regexp_replace(text, '[^0-9Kk]', '', 'g')) AS clean FROM e WHERE entity_type = 'RUT'),
y AS (SELECT *, left(clean, length(clean) - 1) AS b, right(clean, 1) AS k FROM x),
z AS (SELECT *, CASE WHEN regexp_full_match(clean, '[0-9]{{7,8}}[0-9K]') THEN {_RUT_OK} END AS rest FROM y)
SELECT file_id, entity_id, CASE WHEN rest IS NOT NULL AND k = CASE rest WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(rest AS VARCHAR) END
  THEN ltrim(format('{{:,}}', CAST(b AS BIGINT)).replace(',', '.'), '.') || '-' || k END AS rut FROM z"""


def email_values(spark, d):
    return _entities(spark, d).filter("entity_type = 'EMAIL'").select("file_id", "entity_id", v.email(F.col("text")).alias("email"))


_EMAIL = rf"""WITH {_E}, x AS (SELECT file_id, entity_id, text AS v, split_part(text, '@', 1) AS l, lower(split_part(text, '@', -1)) AS dom FROM e WHERE entity_type = 'EMAIL')
SELECT file_id, entity_id, CASE WHEN NOT regexp_matches(v, '[\s\p{{Z}}]') AND length(v) - length(replace(v, '@', '')) = 1 AND l <> ''
  AND regexp_full_match(dom, '[a-z0-9.-]+') AND contains(dom, '.') AND NOT regexp_matches(dom, '^\.|\.$|\.\.') THEN l || '@' || dom END AS email FROM x"""


def phone_values(spark, d):
    return _entities(spark, d).filter("entity_type = 'PHONE'").select("file_id", "entity_id", v.phone(F.col("text")).alias("phone"))


_PHONE = rf"""WITH {_E}, x AS (SELECT file_id, entity_id, text AS v, regexp_replace(text, '[^\p{{Nd}}]', '', 'g') AS raw FROM e WHERE entity_type = 'PHONE'),
y AS (SELECT *, regexp_replace(regexp_replace(raw, '^0056', '56'), '^56', '') AS nat FROM x)
SELECT file_id, entity_id, CASE WHEN regexp_full_match(nat, '[2-79][0-9]{{8}}') AND (regexp_matches(v, '^(\+56|0056)') OR raw LIKE '56%' OR nat LIKE '9%')
  THEN '+56' || nat END AS phone FROM y"""


def luhn_of_keys(spark, d):
    """Luhn-valid 16-digit numbers made of order keys."""
    digits = F.lpad((F.col("o_orderkey") * 7919 + 4_000_000_000_000_000).cast("string"), 16, "4")
    return table(spark, d, "orders").select("o_orderkey", v.card(digits).alias("card"))


_LUHN = """WITH x AS (SELECT o_orderkey, CAST(o_orderkey * 7919 + 4000000000000000 AS VARCHAR) AS n FROM orders)
SELECT o_orderkey, CASE WHEN list_sum(list_transform(range(16), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(n), i + 1, 1) AS INT) * 2
  - CASE WHEN CAST(substr(reverse(n), i + 1, 1) AS INT) > 4 THEN 9 ELSE 0 END ELSE CAST(substr(reverse(n), i + 1, 1) AS INT) END)) % 10 = 0 THEN n END AS card FROM x"""


def dates_of_orders(spark, d):
    """Order dates in three spellings, parsed by both families, with impossible ones."""
    c = F.col("o_orderdate")
    iso, short = F.date_format(c, "yyyy/M/d"), F.concat(F.date_format(c, "d"), F.lit("-"), F.date_format(c, "M"), F.lit("-"), F.date_format(c, "yy"))
    odd = F.concat(((F.col("o_orderkey") % 40)).cast("string"), F.lit("/2/"), F.date_format(c, "yyyy"))
    return table(spark, d, "orders").select(
        "o_orderkey", v.date_in_table(iso, TODAY).alias("iso"), v.date_in_table(short, TODAY).alias("short"), v.date_in_text(odd).alias("odd")
    )


_DATES = """WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, (o_orderkey % 40) AS n, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey, dt AS iso, dt AS short, strftime(coalesce(
  CASE WHEN n BETWEEN 1 AND 31 THEN try_strptime(n || '/2/' || y, '%-d/%-m/%Y') END,
  CASE WHEN n BETWEEN 1 AND 12 THEN try_strptime('2/' || n || '/' || y, '%-d/%-m/%Y') END), '%Y-%m-%d') AS odd FROM x"""


def small_values(spark, d):
    """Ages, plates, addresses, MACs, URLs and IPs made of keys."""
    k = F.col("p_partkey")
    hexes = F.lower(F.lpad(F.hex(k * 7919), 12, "0"))
    return table(spark, d, "part").select(
        "p_partkey", v.age((k % 200).cast("string")).alias("age"),
        v.plate(F.concat(F.lit("jv-tg "), F.lpad((k % 150).cast("string"), 2, "0"))).alias("plate"),
        v.mac(F.regexp_replace(hexes, "(..)(?=.)", "$1:")).alias("mac"),
        v.ip(F.concat_ws(".", F.lit("10"), (k % 300).cast("string"), F.lit("7"), F.lit("1"))).alias("ip"),
        v.url(F.concat(F.when(k % 2 == 0, "https://h").otherwise("nohost"), k.cast("string"), F.when(k % 3 == 0, ".example/x").otherwise(""))).alias("url"),
        v.address(F.concat(F.when(k % 2 == 0, "Av. Siempre ").otherwise("Siempre "), F.when(k % 5 == 0, "Viva").otherwise(k.cast("string")))).alias("address"),
        v.technical(F.when(k % 2 == 0, F.sha2(k.cast("string"), 256)).otherwise(k.cast("string"))).alias("technical"),
        v.name_like(F.col("p_name"), 2, 5).alias("name_like"),
    )


_SMALL = r"""WITH x AS (SELECT *, p_partkey AS k, lower(lpad(hex(p_partkey * 7919), 12, '0')) AS hx,
  lpad(CAST(p_partkey % 150 AS VARCHAR), greatest(2, 2), '0') AS pl, trim(lower(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g'))) AS nk FROM part)
SELECT p_partkey, CASE WHEN k % 200 <= 130 THEN CAST(k % 200 AS VARCHAR) END AS age,
  'JVTG' || left(pl, 2) AS plate, upper(regexp_replace(hx, '(..)(..)(..)(..)(..)(..)', '\1:\2:\3:\4:\5:\6')) AS mac,
  CASE WHEN k % 300 <= 255 THEN '10.' || (k % 300) || '.7.1' END AS ip,
  CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'https://h' ELSE 'nohost' END || k || '.example/x' END AS url,
  k % 2 = 0 AND k % 5 <> 0 AS address, k % 2 = 0 AS technical,
  NOT regexp_matches(p_name, '[0-9]') AND len(string_split(nk, ' ')) BETWEEN 2 AND 5 AND length(nk) <= 80
    AND len(list_filter(string_split(nk, ' '), lambda w: NOT regexp_full_match(w, '[a-z]{2,}'))) = 0 AS name_like FROM x"""


def canonical_types(spark, d):
    """Canonical type and decision route of each recorded type, and of the names
    that detectors give: aliases, suffixes, the label model's prefix, unknown ones."""
    rows = _entities(spark, d).select("entity_type", "raw_entity_type")
    names = [a for some in tn.TYPE_ALIASES.values() for a in some] + ["AGE", "PASSWORD", "MEDICAL_TEST", "SOMETHING"]
    spelled = [(f"{prefix}{n.lower() if prefix else n}{suffix}", None) for n in names for prefix in ("", "GLINER2_") for suffix in ("", "_REGEX", "_DENY_LIST", "_CONTEXT_REGEX")]
    rows = rows.unionByName(spark.createDataFrame(spelled + [("OTHER", n) for n in names], "entity_type string, raw_entity_type string"))
    kind = tn.canonical_type(F.col("entity_type"), F.col("raw_entity_type"))
    way = F.when(kind.isin(*tn.BASE_TYPES), "base").when(kind.isin(*tn.LOCAL_TYPES), "local").when(kind.isin(*tn.SCORE_TYPES), "score").when(kind.isin(*tn.MODEL_TYPES), "model").otherwise("none")
    return rows.select(kind.alias("canonical"), way.alias("route")).groupBy("canonical", "route").agg(F.count("*").alias("n"))


_ALIAS_ROWS = ", ".join(f"('{kind}', '{a}')" for kind, some in tn.TYPE_ALIASES.items() for a in some)
_TYPES = f"""WITH {_E}, a(kind, alias) AS (VALUES {_ALIAS_ROWS}), named AS (SELECT alias AS n FROM a UNION ALL SELECT unnest(['AGE', 'PASSWORD', 'MEDICAL_TEST', 'SOMETHING'])),
x AS (SELECT entity_type AS t, raw_entity_type AS r FROM e UNION ALL
  SELECT p || CASE WHEN p = '' THEN n ELSE lower(n) END || s, NULL FROM named CROSS JOIN (SELECT unnest(['', 'GLINER2_']) AS p) CROSS JOIN (SELECT unnest(['', '_REGEX', '_DENY_LIST', '_CONTEXT_REGEX']) AS s)
  UNION ALL SELECT 'OTHER', n FROM named),
y AS (SELECT regexp_replace(regexp_replace(upper(trim(t)), '(_CONTEXT_REGEX|_DENY_LIST|_REGEX)$', ''), '^GLINER2_', '') AS t,
             regexp_replace(regexp_replace(upper(trim(coalesce(r, ''))), '(_CONTEXT_REGEX|_DENY_LIST|_REGEX)$', ''), '^GLINER2_', '') AS r FROM x),
f AS (SELECT unnest({_list((*tn.BASE_TYPES, *tn.LOCAL_TYPES, *tn.SCORE_TYPES, *tn.MODEL_TYPES))}) AS fixed),
z AS (SELECT coalesce((SELECT kind FROM a WHERE alias = t), (SELECT fixed FROM f WHERE fixed = t), (SELECT kind FROM a WHERE alias = r), (SELECT fixed FROM f WHERE fixed = r), t) AS canonical FROM y)
SELECT canonical, CASE WHEN list_contains({_list(tn.BASE_TYPES)}, canonical) THEN 'base' WHEN list_contains({_list(tn.LOCAL_TYPES)}, canonical) THEN 'local'
  WHEN list_contains({_list(tn.SCORE_TYPES)}, canonical) THEN 'score' WHEN list_contains({_list(tn.MODEL_TYPES)}, canonical) THEN 'model' ELSE 'none' END AS route, count(*) AS n FROM z GROUP BY ALL"""


# ---- spans ------------------------------------------------------------------------------


def email_spans(spark, d):
    """E-mail spans of all chunks."""
    some = tuple(p for p in PATTERNS if p.entity_type == "EMAIL")
    return pattern_spans(_chunks(spark, d), patterns=some).select("chunk_id", F.col("span_text").alias("email")).groupBy("chunk_id", "email").agg(F.count("*").alias("n"))


_EMAIL_SPANS = rf"""WITH {_C}, x AS (SELECT chunk_id, unnest(regexp_extract_all(text, '(?i)([A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}})(?:[^A-Za-z0-9._%+-]|$)', 1)) AS email FROM c)
SELECT chunk_id, email, count(*) AS n FROM x GROUP BY ALL"""


def rut_spans_valid(spark, d):
    """National ids written in the chunks, valid ones by chunk."""
    some = tuple(p for p in PATTERNS if p.entity_type == "RUT")
    found = pattern_spans(_chunks(spark, d), patterns=some)
    return found.select("chunk_id", v.rut(F.col("span_text")).alias("rut")).filter("rut is not null").distinct()


_RUT_SPANS = rf"""WITH {_C}, s AS (
  SELECT chunk_id, unnest(regexp_extract_all(text, '(?:^|[^A-Za-z0-9])([0-9]{{1,2}}\.?[0-9]{{3}}\.?[0-9]{{3}}\s*-\s*[0-9Kk])(?:[^A-Za-z0-9]|$)', 1)) AS t FROM c),
x AS (SELECT chunk_id, upper(regexp_replace(t, '[^0-9Kk]', '', 'g')) AS clean FROM s),
y AS (SELECT *, left(clean, length(clean) - 1) AS b, right(clean, 1) AS k FROM x WHERE regexp_full_match(clean, '[0-9]{{7,8}}[0-9K]')),
z AS (SELECT *, {_RUT_OK} AS rest FROM y)
SELECT DISTINCT chunk_id, format('{{:,}}', CAST(b AS BIGINT)).replace(',', '.') || '-' || k AS rut FROM z
WHERE k = CASE rest WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(rest AS VARCHAR) END"""


def term_hits(spark, d):
    """Dictionary terms in the chunks by type."""
    return term_spans(_chunks(spark, d)).groupBy("entity_type").agg(F.count("*").alias("hits"), F.count_distinct("chunk_id").alias("chunks"))


# Every sign that is no word character is doubled, so that neighbours can share it.
_TERM_ROWS = ", ".join(
    f"('{kind}', '(^|[^0-9A-Za-z_])' || '{re.sub(r"\s+", r"[ \\n\\t]+", term.lower()).replace(".", "[.][.]")}' || '($|[^0-9A-Za-z_])')" for kind, terms in TERMS.items() for term in dict.fromkeys(x.lower() for x in terms)
)
_TERM_HITS = rf"""WITH {_C}, t(kind, re) AS (VALUES {_TERM_ROWS}), x AS (SELECT chunk_id, regexp_replace(lower(strip_accents(text)), '([^0-9A-Za-z_])', '\1\1', 'g') AS u FROM c),
h AS (SELECT kind, chunk_id, len(regexp_extract_all(u, re)) AS n FROM x CROSS JOIN t)
SELECT kind AS entity_type, CAST(sum(n) AS BIGINT) AS hits, count(DISTINCT chunk_id) AS chunks FROM h WHERE n > 0 GROUP BY 1"""


def detected_counts(spark, d):
    """All spans of all detectors by type and source, with offsets that must fit the text."""
    found = detect(_chunks(spark, d))
    fits = F.substring("text", F.col("start_pos") + 1, F.col("end_pos") - F.col("start_pos")) == F.col("span_text")
    return found.groupBy("raw_entity_type", "source").agg(F.count("*").alias("spans"), F.count(F.when(~fits, 1)).alias("misfits"))


def accepted_entities(spark, d):
    """Detected, gated, resolved and deduplicated entities of all files."""
    return resolution.resolve(detect(_chunks(spark, d)).drop("text")).drop("evidence")


# ---- span algebra over the recorded entities, placed by index -----------------------------


def _placed(spark: SparkSession, d: str) -> DataFrame:
    """Recorded entities of a file as spans of one line: place from index and length."""
    return _entities(spark, d).select(
        "file_id", F.col("primary_location.chunk_id").alias("chunk_id"), "entity_id", "entity_type", "raw_entity_type", "source", "score",
        F.col("text").alias("span_text"), F.col("entity_index").alias("chunk_index"), (F.col("entity_index") * 7).alias("start_pos"),
        (F.col("entity_index") * 7 + F.length("text")).alias("end_pos"), F.col("entity_id").alias("__id"),
    )


_S = f"""{_E}, s AS (SELECT file_id, primary_location.chunk_id AS chunk_id, entity_id, entity_type, raw_entity_type, source, score, text,
  entity_index AS chunk_index, entity_index * 7 AS start_pos, entity_index * 7 + length(text) AS end_pos FROM e)"""


def overlap_join(spark, d):
    """Pairs of overlapping spans of a chunk with the length they share."""
    s = _placed(spark, d)
    pairs = resolution.overlap_pairs(s, s).filter(F.col("a.entity_id") < F.col("b.entity_id"))
    return pairs.select(F.col("a.file_id"), F.col("a.entity_id").alias("a"), F.col("b.entity_id").alias("b"), F.col("shared").cast("long").alias("shared"))


_OVERLAP = f"""WITH {_S} SELECT a.file_id, a.entity_id AS a, b.entity_id AS b, CAST(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) AS BIGINT) AS shared
FROM s a JOIN s b ON a.file_id = b.file_id AND a.chunk_id = b.chunk_id AND a.entity_id < b.entity_id AND greatest(a.start_pos, b.start_pos) < least(a.end_pos, b.end_pos)"""


def overlap_islands(spark, d):
    """The connected group of overlapping spans that each span belongs to."""
    return resolution.islands(_placed(spark, d)).select("file_id", "entity_id", F.col("island").cast("long").alias("island"))


_ISLANDS = f"""{{pre}} i AS (SELECT *, sum(o) OVER (PARTITION BY file_id, chunk_id ORDER BY start_pos, end_pos, entity_type, raw_entity_type, entity_id) AS island FROM (
  SELECT *, CASE WHEN max(end_pos) OVER (PARTITION BY file_id, chunk_id ORDER BY start_pos, end_pos, entity_type, raw_entity_type, entity_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > start_pos THEN 0 ELSE 1 END AS o FROM s))""".replace("{{pre}}", f"WITH {_S},").replace("{pre}", f"WITH {_S},")
_RANK = """CASE source WHEN 'presidio' THEN 1 WHEN 'regex' THEN 2 WHEN 'deny_list' THEN 2 WHEN 'gliner2' THEN 3 WHEN 'medical_model' THEN 4 WHEN 'humadex' THEN 4 ELSE 9 END"""


def island_choice(spark, d):
    """The best five spans of each group and the best of each type in it."""
    return resolution.island_choice(_placed(spark, d)).select("file_id", "entity_id")


_CHOICE = (
    _ISLANDS
    + f""" SELECT file_id, entity_id FROM i QUALIFY row_number() OVER (PARTITION BY file_id, chunk_id, island ORDER BY score DESC, end_pos - start_pos DESC, {_RANK},
  chunk_index, start_pos, end_pos, entity_type, raw_entity_type, text, entity_id) <= 5 OR row_number() OVER (PARTITION BY file_id, chunk_id, island, entity_type
  ORDER BY score DESC, end_pos - start_pos DESC, {_RANK}, chunk_index, start_pos, end_pos, entity_type, raw_entity_type, text, entity_id) = 1"""
)


def greedy_kept(spark, d):
    """Spans kept when a chunk's spans are taken greedily in decision order."""
    rows = resolution.ranked(_placed(spark, d).withColumn("confidence_level", F.lit("PROBABLE")).withColumn("decision_score", F.col("score")))
    kept = resolution.greedy(rows).filter("rank = owner")
    return rows.join(kept.select("file_id", "chunk_id", "rank"), ["file_id", "chunk_id", "rank"], "left_semi").select("file_id", "entity_id")


_GREEDY = f"""WITH RECURSIVE {_S}, k AS (SELECT *, row_number() OVER (PARTITION BY file_id, chunk_id ORDER BY score DESC, end_pos - start_pos DESC, {_RANK},
  chunk_index, start_pos, end_pos, entity_type, raw_entity_type, entity_id) AS n FROM s),
g AS (
  SELECT file_id, chunk_id, n, [{{'s': start_pos, 'e': end_pos, 'id': entity_id}}] AS kept FROM k WHERE n = 1
  UNION ALL
  SELECT g.file_id, g.chunk_id, k.n, CASE WHEN len(list_filter(g.kept, lambda x: greatest(x.s, k.start_pos) < least(x.e, k.end_pos))) > 0 THEN g.kept
    ELSE list_append(g.kept, {{'s': k.start_pos, 'e': k.end_pos, 'id': k.entity_id}}) END
  FROM g JOIN k ON k.file_id = g.file_id AND k.chunk_id = g.chunk_id AND k.n = g.n + 1)
SELECT file_id, unnest(list_transform(arg_max(kept, n), lambda x: x.id)) AS entity_id FROM g GROUP BY file_id, chunk_id"""


def gated_entities(spark, d):
    """Recorded entities of no base type that their route accepts: dates and ages by
    their values, others by score, the rest by a scorer, here the text's length."""
    rows = _placed(spark, d).withColumns({"normalized_value": F.lit(None).cast("string"), "value_key": F.lit(None).cast("string")})
    out = resolution.gated(rows, lambda asked: asked.withColumn("model_score", (F.length("span_text") % 11) / 10))
    return out.select("file_id", "entity_id", "confidence_level", F.round("decision_score", 6).alias("decision_score"), "decision_method", "normalized_value")


_ASKED = _S.replace("FROM e)", f"FROM e WHERE entity_type IN ({', '.join(repr(x) for x in tn.MODEL_TYPES)}) AND score >= 0.5)")
_GATED = (
    _CHOICE.replace(_S, _ASKED)
    .replace("WITH ", "WITH asked AS (WITH ", 1) + f"""),
x AS (SELECT * FROM {E_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, entity_id ORDER BY updated_at DESC) = 1),
l AS (SELECT file_id, entity_id, score, CASE entity_type WHEN 'AGE' THEN CASE WHEN regexp_full_match(trim(text), '[0-9]{{1,3}}') AND CAST(trim(text) AS INT) <= 130 THEN CAST(CAST(trim(text) AS INT) AS VARCHAR) END
  WHEN 'DATE' THEN strftime(coalesce(try_strptime(text, '%d/%m/%Y'), try_strptime(text, '%m/%d/%Y')), '%Y-%m-%d') END AS v FROM x WHERE entity_type IN ('AGE', 'DATE'))
SELECT file_id, entity_id, 'PROBABLE' AS confidence_level, round(score, 6) AS decision_score, 'local_validation' AS decision_method, v AS normalized_value FROM l WHERE v IS NOT NULL
UNION ALL SELECT file_id, entity_id, 'PROBABLE', round(score, 6), 'model_score_threshold', NULL FROM x WHERE score > 0.9 AND entity_type IN ({', '.join(repr(t) for t in tn.SCORE_TYPES)})
UNION ALL SELECT file_id, entity_id, CASE WHEN length(text) % 11 >= 9 THEN 'CONFIDENT' ELSE 'PROBABLE' END, (length(text) % 11) / 10, 'zero_shot', NULL
FROM x JOIN asked USING (file_id, entity_id) WHERE length(text) % 11 >= 5"""
)


def base_values(spark, d):
    """The normalized value of every entity of a base type."""
    rows = _entities(spark, d).withColumn("kind", tn.canonical_type(F.col("entity_type"))).filter(F.col("kind").isin(*tn.BASE_TYPES))
    return rows.select("file_id", "entity_id", v.normalized_base(F.col("kind"), F.col("text")).alias("value"))


_BASE_VALUES = rf"""SELECT file_id, entity_id, rut AS value FROM ({_RUT}) UNION ALL SELECT file_id, entity_id, email FROM ({_EMAIL}) UNION ALL SELECT file_id, entity_id, phone FROM ({_PHONE})
UNION ALL SELECT file_id, entity_id, nullif(lower(trim(regexp_replace(text, '[\s\p{{Z}}]+', ' ', 'g'))), '') FROM (SELECT * FROM {E_TABLE} QUALIFY row_number() OVER (PARTITION BY file_id, entity_id ORDER BY updated_at DESC) = 1)
WHERE entity_type IN ('HEALTH_SYSTEM', 'MARITAL_STATUS', 'PENSION_SYSTEM', 'RELIGION_OR_BELIEF')"""


def entity_ids(spark, d):
    """Ids of the recorded entities from what they are and where."""
    keys = _entities(spark, d).select("file_id", "entity_id", "value_key")
    return _placed(spark, d).join(keys, ["file_id", "entity_id"]).select("file_id", "entity_id", resolution.entity_identity().alias("made_id"))


_IDS = f"""WITH {_S} SELECT s.file_id, s.entity_id, left(sha256(concat_ws('|', s.entity_type, e.value_key, s.chunk_id, s.start_pos, s.end_pos, s.source, s.raw_entity_type)), 16) AS made_id
FROM s JOIN e ON e.file_id = s.file_id AND e.entity_id = s.entity_id"""


def best_overlaps(spark, d):
    """For each span of no base type, the one of a base type that it shares most with."""
    s = _placed(spark, d)
    base = s.filter(F.col("entity_type").isin(*tn.BASE_TYPES))
    pairs = resolution.overlap_pairs(s.filter(~F.col("entity_type").isin(*tn.BASE_TYPES)), base)
    best = F.min(F.struct((-F.col("shared")).alias("o"), F.col("b.entity_id").alias("target"))).alias("best")
    return pairs.groupBy(F.col("a.file_id").alias("file_id"), F.col("a.entity_id").alias("entity_id")).agg(best).select("file_id", "entity_id", "best.target")


_BEST = f"""WITH {_S} SELECT a.file_id, a.entity_id, b.entity_id AS target FROM s a JOIN s b ON a.file_id = b.file_id AND a.chunk_id = b.chunk_id AND greatest(a.start_pos, b.start_pos) < least(a.end_pos, b.end_pos)
WHERE NOT list_contains({_list(tn.BASE_TYPES)}, a.entity_type) AND list_contains({_list(tn.BASE_TYPES)}, b.entity_type)
QUALIFY row_number() OVER (PARTITION BY a.file_id, a.entity_id ORDER BY least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) DESC, b.entity_id) = 1"""


def value_dedupe(spark, d):
    return reporting.dedupe_by_value(table(spark, d, E_TABLE))


_DEDUPE = f"""WITH {_E} SELECT file_id, entity_type, value_key, entity_id, score, count(*) OVER (PARTITION BY file_id, entity_type, value_key) AS evidence_count FROM e
QUALIFY row_number() OVER (PARTITION BY file_id, entity_type, value_key ORDER BY score DESC, entity_index, entity_id) = 1"""


# ---- discovery over tables -----------------------------------------------------------------

DISCOVERED = ["files", "queue_outbox", "customer", "supplier", "part", "orders", "nation"]


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: table(spark, d, t) for t in DISCOVERED}


def header_types(spark, d):
    """What the column names of the tables tell."""
    profiles = [p for t, df in _tables(spark, d).items() for p in discovery.profile_of(df, t)]
    context = discovery.contexts(spark, profiles)
    return context.select("table_name", "column_name", "column_key", "date_type", "numeric_type", "specific", F.size("header_types").alias("told"))


_TYPE_ROWS = ", ".join(f"('{k}', {_list(discovery.HEADER_TOKENS[k])}, {_list(discovery.HEADER_PHRASES[k])})" for k in discovery.ENTITY_ORDER)
_HEADERS = rf"""WITH t(kind, tokens, phrases) AS (VALUES {_TYPE_ROWS}),
c AS ({" UNION ALL ".join(f"SELECT '{x}' AS table_name, column_name, lower(column_type) AS ct FROM (DESCRIBE {x})" for x in DISCOVERED)}),
k AS (SELECT *, lower(trim(regexp_replace(strip_accents(column_name), '[^A-Za-z0-9]+', '_', 'g'), '_')) AS column_key FROM c),
w AS (SELECT *, string_split(column_key, '_') AS words FROM k)
SELECT table_name, column_name, column_key, contains(ct, 'date') OR contains(ct, 'time') AS date_type,
  len(list_filter({_list(discovery.NUMERIC_WORDS)}, lambda n: contains(ct, n))) > 0 AS numeric_type,
  NOT list_contains({_list(discovery.GENERIC_WORDS)}, column_key) AND NOT list_has_all({_list(discovery.GENERIC_WORDS)}, words) AS specific,
  (SELECT count(*) FROM t WHERE list_contains(phrases, column_key) OR list_has_any(words, tokens)) AS told FROM w"""


def match_rates(spark, d):
    """How many values of the columns of two tables pass each check."""
    frames = {t: table(spark, d, t) for t in ("files", "orders")}
    out = discovery.match_rates(frames, {t: discovery.profile_of(df, t) for t, df in frames.items()}, TODAY)
    return out.filter("entity_type IN ('EMAIL', 'DATE', 'TECHNICAL', 'GENDER_IDENTITY')")


RATED = [
    *DISCOVERED, "ingestion_runs", "file_snapshot_tombstones", "text_extraction_pages", "text_chunks_staging", "entity_extraction_entities", "documents",
    "eval_items", "chunk_limits", "region", "lineitem", "events", "embeddings",
]


def match_rates_all(spark, d):
    """How many values of the columns of all tables pass each check."""
    frames = {t: table(spark, d, t) for t in RATED}
    return discovery.match_rates(frames, {t: discovery.profile_of(df, t) for t, df in frames.items()}, TODAY)


# Dates by value: the written form, a day that the calendar has from 1900 to today, in a column whose name doesn't speak against a birth.
_DATE_OK = r"""regexp_full_match(x, '(\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.](\d{{2}}|\d{{4}}))([T\s]+\d{{1,2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?)?')
    AND (NOT list_has_any(string_split(cols.column_name, '_'), {not_birth}) OR list_has_any(string_split(cols.column_name, '_'), {told}) OR list_contains({phrases}, cols.column_name))
    AND coalesce(CASE WHEN regexp_matches(x, '^\d{{4}}') THEN try_cast(regexp_replace(x, '^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}).*$', '\1-\2-\3') AS DATE) BETWEEN DATE '1900-01-01' AND DATE '{today}'
      ELSE try_cast(regexp_replace(x, '^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}).*$', '\3-\2-\1') AS DATE) BETWEEN DATE '1900-01-01' AND DATE '{today}'
        OR try_cast(regexp_replace(x, '^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}).*$', '\3-\1-\2') AS DATE) BETWEEN DATE '1900-01-01' AND DATE '{today}' END, false)""".format(
    not_birth=_list(discovery.NOT_BIRTH_WORDS), told=_list(discovery.HEADER_TOKENS["DATE"]), phrases=_list(discovery.HEADER_PHRASES["DATE"]), today=TODAY
)
_RATES = r"""WITH v AS (
  SELECT 'files' AS table_name, column_name, trim(left(trim(value), 256)) AS x FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
    SELECT * REPLACE (CAST(discovered_at AS TIMESTAMP) AS discovered_at, CAST(updated_at AS TIMESTAMP) AS updated_at) FROM files)) ON COLUMNS(*) INTO NAME column_name VALUE value)
  UNION ALL
  SELECT 'orders', column_name, trim(value) FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT * REPLACE (CAST(o_orderdate AS TIMESTAMP) AS o_orderdate) FROM orders))
    ON COLUMNS(*) INTO NAME column_name VALUE value)
), n AS (SELECT * FROM v WHERE x <> ''),
cols AS (SELECT DISTINCT table_name, column_name FROM (SELECT table_name, column_name FROM v UNION ALL
  SELECT 'files', column_name FROM (DESCRIBE files) UNION ALL SELECT 'orders', column_name FROM (DESCRIBE orders))),
k AS (SELECT unnest(['EMAIL', 'DATE', 'TECHNICAL', 'GENDER_IDENTITY']) AS entity_type)
SELECT cols.table_name, cols.column_name, k.entity_type, coalesce(count(n.x) FILTER (CASE k.entity_type
    WHEN 'EMAIL' THEN regexp_full_match(x, '(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}')
    WHEN 'DATE' THEN @DATE_OK@
    WHEN 'TECHNICAL' THEN NOT regexp_matches(x, '\s') AND (regexp_full_match(x, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') OR regexp_full_match(x, '[0-9a-fA-F]{24,128}')
      OR (length(x) >= 32 AND regexp_full_match(x, '[A-Za-z0-9_+/=-]+')))
    ELSE lower(x) IN ('femenino', 'hombre', 'masculino', 'mujer', 'trans') END), 0) AS matched, count(n.x) AS sampled
FROM cols CROSS JOIN k LEFT JOIN n ON n.table_name = cols.table_name AND n.column_name = cols.column_name GROUP BY ALL""".replace("@DATE_OK@", _DATE_OK)


def column_findings(spark, d):
    """Columns that hold personal data, direct and passed on by name."""
    return discovery.discover(_tables(spark, d), TODAY).drop("position", "specific", "foreign_key", "schema_name")


def findings_by_level(spark, d):
    return reporting.findings_summary(discovery.discover(_tables(spark, d), TODAY))


def findings_projection(spark, d):
    return reporting.findings_projection(discovery.discover(_tables(spark, d), TODAY))


# ---- inventory ----------------------------------------------------------------------------


def route_files(spark, d):
    """Route, queue and reason of every file."""
    rows = latest(table(spark, d, "files"), ["file_id"])
    r = inventory.route(F.col("extension"), F.col("mime_type"))
    return rows.select("file_id", r.alias("r")).select("file_id", "r.*")


_ROUTE = rf"""WITH {_F}, x AS (SELECT file_id, lower(trim(coalesce(mime_type, ''))) AS m, CASE WHEN trim(coalesce(extension, '')) = '' THEN ''
  WHEN extension LIKE '.%' THEN lower(trim(extension)) ELSE '.' || lower(trim(extension)) END AS e FROM f),
y AS (SELECT *, CASE WHEN e <> '' AND m NOT LIKE 'application/vnd.google-apps.%' THEN CASE WHEN e = '.pdf' THEN 'pdf_extension'
  WHEN e IN ('.png', '.jpg', '.jpeg', '.tif', '.tiff', '.bmp', '.webp') THEN 'image_extension' WHEN e IN ('.csv', '.xlsx', '.xlsm') THEN 'tabular_extension'
  WHEN e IN ('.txt', '.docx') THEN 'document_extension' WHEN e = '.xls' THEN 'legacy_excel_not_supported' WHEN e = '.doc' THEN 'legacy_word_not_supported'
  ELSE 'unsupported_extension' END
  WHEN m = '' THEN 'missing_extension' WHEN m = 'application/pdf' THEN 'pdf_mime' WHEN m LIKE 'image/%' THEN 'image_mime'
  WHEN m = 'application/vnd.google-apps.document' THEN 'google_document_mime' WHEN m = 'application/vnd.google-apps.spreadsheet' THEN 'google_spreadsheet_mime'
  WHEN m = 'application/vnd.google-apps.presentation' THEN 'google_presentation_mime'
  WHEN m IN ('text/csv', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet', 'application/vnd.ms-excel.sheet.macroenabled.12') THEN 'tabular_mime'
  WHEN m IN ('text/plain', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document') THEN 'document_mime' ELSE 'unsupported_mime_type' END AS reason FROM x),
z AS (SELECT file_id, reason, CASE WHEN reason LIKE 'pdf%' THEN 'pdf' WHEN reason LIKE 'image%' THEN 'ocr' WHEN reason IN ('tabular_extension', 'tabular_mime', 'google_spreadsheet_mime') THEN 'table'
  WHEN reason LIKE 'document%' OR reason LIKE 'google%' THEN 'doc' ELSE 'unsupported' END AS route_type FROM y)
SELECT file_id, route_type, CASE route_type WHEN 'pdf' THEN 'Queue-PDF' WHEN 'ocr' THEN 'Queue-OCR' WHEN 'table' THEN 'Queue-Tables' WHEN 'doc' THEN 'Queue-Doc' ELSE 'Queue-Unsupported' END AS queue,
  reason, CASE WHEN route_type = 'unsupported' THEN 'unsupported' ELSE 'routed' END AS route_status FROM z"""


def revision_keys(spark, d):
    """Revision and idempotency keys of every file row."""
    r = inventory.route(F.col("extension"), F.col("mime_type"))["route_type"]
    return latest(table(spark, d, "files"), ["file_id"]).select("file_id", inventory.revision_key().alias("revision"), inventory.idempotency_key(r).alias("message_key"))


_TRIM = r"nullif(regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '')"
_REV = "coalesce('sha256:' || {0}, 'content:' || {1}, 'etag:' || {2})".format(*[_TRIM.format(c) for c in ("checksum_sha256", "content_hash", "etag")])
_REVISION = (
    _ROUTE.rsplit("SELECT file_id, route_type", 1)[0]
    + f""" SELECT f.file_id, {_REV} AS revision, 'file.routed:' || run_id || ':' || f.file_id || ':' || coalesce(nullif(content_hash, ''), nullif(etag, ''), nullif(checksum_sha256, ''),
  CAST(nullif(size_bytes, 0) AS VARCHAR), 'unknown') || ':' || route_type || ':v1' AS message_key FROM f JOIN z ON z.file_id = f.file_id"""
)


def snapshot_states(spark, d):
    return inventory.snapshot_states(table(spark, d, "files"), table(spark, d, "ingestion_runs"))


_STATES = f"""WITH {_F}, {_R}, x AS (SELECT f.file_id, f.source_uri, r.*, {_REV} AS revision FROM f JOIN r USING (run_id)),
y AS (SELECT *, lag(file_id) OVER w AS prev, lag(revision) OVER w AS prev_revision FROM x WINDOW w AS (PARTITION BY user_id, source_type, source_scope_key, source_uri ORDER BY seq, file_id))
SELECT run_id, file_id, source_uri, CASE WHEN prev IS NULL THEN 'new' WHEN revision IS NULL OR prev_revision IS NULL OR revision <> prev_revision THEN 'modified' ELSE 'reused' END AS state,
  prev AS previous_file_id FROM y"""


def tombstones(spark, d):
    return inventory.tombstones(table(spark, d, "files"), table(spark, d, "ingestion_runs"))


_TOMB = f"""WITH {_F}, {_R} SELECT n.run_id, f.source_uri, f.file_id AS previous_file_id FROM r n JOIN f ON f.run_id = n.prior
WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.run_id = n.run_id AND g.source_uri = f.source_uri)"""


def snapshot_counters(spark, d):
    return inventory.snapshot_counters(table(spark, d, "files"), table(spark, d, "ingestion_runs"))


_COUNTERS = (
    _STATES.rsplit("SELECT run_id, file_id", 1)[0]
    + """, t AS (SELECT n.run_id, count(*) AS deleted FROM r n JOIN f ON f.run_id = n.prior WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.run_id = n.run_id AND g.source_uri = f.source_uri) GROUP BY 1),
u AS (SELECT run_id, count(*) FILTER (prev IS NULL) AS new, count(*) FILTER (prev IS NOT NULL AND (revision IS NULL OR prev_revision IS NULL OR revision <> prev_revision)) AS modified,
  count(*) FILTER (prev IS NOT NULL AND revision = prev_revision) AS reused FROM y GROUP BY 1)
SELECT r.run_id, coalesce(new, 0) AS new, coalesce(modified, 0) AS modified, coalesce(reused, 0) AS reused, CAST(0 AS BIGINT) AS reprocessed, coalesce(deleted, 0) AS deleted
FROM r LEFT JOIN u USING (run_id) LEFT JOIN t USING (run_id)"""
)


def page_routes(spark, d):
    """How each page would be read, from its recorded text and image shares."""
    rows = latest(table(spark, d, P_TABLE), ["file_id", "page_number"])
    r = inventory.page_route(F.col("char_count"), F.col("word_count"), F.col("total_image_ratio"), F.col("largest_image_ratio"))
    return rows.select("file_id", "page_number", r.alias("r")).select("file_id", "page_number", F.col("r.method").alias("way"), F.col("r.reason").alias("why"))


_PAGE = f"""WITH {_P} SELECT file_id, page_number, CASE WHEN largest_image_ratio >= 0.55 OR total_image_ratio >= 0.7 THEN 'ocr' WHEN char_count >= 80 OR word_count >= 12 THEN 'pymupdf' ELSE 'ocr' END AS way,
  CASE WHEN largest_image_ratio >= 0.55 OR total_image_ratio >= 0.7 THEN 'image_dominant' WHEN char_count >= 80 OR word_count >= 12 THEN 'embedded_text' ELSE 'insufficient_text' END AS why FROM p"""


# ---- chunks ---------------------------------------------------------------------------------


def document_chunks(spark, d):
    """Documents as paragraph blocks, chunked with overlap; chunks with sizes."""
    blocks = chunking.paragraph_blocks(table(spark, d, "documents"), "doc_id", "text")
    return chunking.build_chunks(blocks).select("chunk_id", "chunk_index", "text_hash_sha256", F.length("text").alias("n"), F.size("segments").alias("segments"))


def document_blocks(spark, d):
    """Paragraph blocks of documents."""
    return chunking.paragraph_blocks(table(spark, d, "documents"), "doc_id", "text").groupBy("file_id").agg(F.count("*").alias("blocks"))


_BLOCKS = r"""WITH l AS (SELECT doc_id, list_transform(string_split_regex(text, '\r\n|\r|\n'), lambda x: trim(x)) AS ls FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, list_filter(string_split_regex(array_to_string(ls, chr(10)), '\n\n+'), lambda p: trim(replace(p, chr(10), '')) <> '') AS ps FROM l)
SELECT CAST(doc_id AS VARCHAR) AS file_id, len(ps) AS blocks FROM x WHERE len(ps) > 0"""


def chunk_offsets(spark, d):
    return reporting.chunk_offsets(table(spark, d, C_TABLE))


_OFFSETS = f"""WITH {_C} SELECT chunk_id, CAST(coalesce(sum(length(text) + 1) OVER w, 0) AS BIGINT) AS start_pos, CAST(coalesce(sum(length(text) + 1) OVER w, 0) + length(text) AS BIGINT) AS end_pos
FROM c WINDOW w AS (PARTITION BY file_id ORDER BY chunk_index, chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def chunk_reindex(spark, d):
    return reporting.reindexed(table(spark, d, C_TABLE))


_REINDEX = f"""WITH {_C}, x AS (SELECT chunk_id, file_id, row_number() OVER (PARTITION BY file_id ORDER BY page_start, page_end, chunk_index, chunk_id) AS n FROM c)
SELECT chunk_id, n AS new_index, file_id || ':c' || lpad(CAST(n AS VARCHAR), 6, '0') AS new_chunk_id FROM x"""


def chunk_hashes(spark, d):
    """Chunks whose recorded hash isn't that of their text."""
    rows = _chunks(spark, d)
    full = latest(table(spark, d, C_TABLE), ["chunk_id"])
    return full.select("chunk_id", (F.sha2("text", 256) == F.col("text_hash_sha256")).alias("hash_fits"), F.length(tn.chunk_text(F.col("text"))).alias("flat_chars")).join(
        rows.select("chunk_id"), "chunk_id", "left_semi"
    )


_HASHES = rf"""WITH {_C} SELECT chunk_id, sha256(text) = text_hash_sha256 AS hash_fits, length(trim(regexp_replace(text, '[\s\p{{Z}}]+', ' ', 'g'))) AS flat_chars FROM c"""


# ---- reports ----------------------------------------------------------------------------------


def entity_summary(spark, d):
    return reporting.entity_summary(_entities(spark, d))


_SUMMARY = f"WITH {_E} SELECT entity_type, source, count(*) AS entities, CAST(grouping(entity_type, source) AS INT) AS level FROM e GROUP BY GROUPING SETS ((entity_type), (source), (entity_type, source))"


def page_rollup(spark, d):
    return reporting.page_rollup(table(spark, d, P_TABLE))


_ROLLUP = f"""WITH {_P}, x AS (SELECT file_id, count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status IN ('failed', 'quarantined')) AS failed,
  coalesce(max(char_count), 0) AS most_chars, CAST(sum(word_count) AS BIGINT) AS words, round(coalesce(avg(total_image_ratio), 0), 6) AS image_share FROM p GROUP BY 1)
SELECT *, total - completed - failed AS pending, CASE WHEN failed > 0 THEN 'failed' WHEN total - completed - failed > 0 THEN 'waiting' ELSE 'completed' END AS file_status FROM x"""


def consecutive_scanned(spark, d):
    """Runs of consecutive pages read by recognition."""
    return reporting.consecutive_pages(table(spark, d, P_TABLE), "ocr")


_CONSECUTIVE = f"""WITH {_P}, x AS (SELECT file_id, page_number, page_number - row_number() OVER (PARTITION BY file_id ORDER BY page_number) AS i FROM p WHERE method = 'ocr')
SELECT file_id, min(page_number) AS first_page, max(page_number) AS last_page, count(*) AS pages FROM x GROUP BY file_id, i"""


def entity_index(spark, d):
    return reporting.stable_index(table(spark, d, E_TABLE))


_INDEX = f"WITH {_E} SELECT file_id, entity_id, row_number() OVER (PARTITION BY file_id ORDER BY coalesce(entity_index, 1000000000), entity_id) - 1 AS dense_index FROM e"


def latest_snapshots(spark, d):
    return reporting.latest_snapshots(table(spark, d, "ingestion_runs"))


_LATEST = f"WITH {_R} SELECT user_id, source_type, source_scope_key, arg_max(run_id, seq) AS run_id, max(done) AS completed_at FROM r GROUP BY ALL"


def run_overview(spark, d):
    return reporting.run_overview(table(spark, d, "ingestion_runs"), table(spark, d, "files"))


_OVERVIEW = f"""WITH {_F}, x AS (SELECT run_id, count(*) AS files, count(DISTINCT source_uri) AS uris, count(DISTINCT lower(extension)) AS extensions, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes FROM f GROUP BY 1)
SELECT r.run_id, coalesce(files, 0) AS files, coalesce(uris, 0) AS uris, coalesce(extensions, 0) AS extensions, coalesce(bytes, 0) AS bytes FROM (SELECT DISTINCT run_id FROM ingestion_runs) r LEFT JOIN x USING (run_id)"""


def pending_outbox(spark, d):
    return reporting.pending_outbox(table(spark, d, "queue_outbox"))


_PENDING = "SELECT delivery_no, queue_name, status, attempts, created_at, left(last_error, 2000) AS last_error FROM queue_outbox WHERE published_at IS NULL"


def pending_top(spark, d):
    """The twenty oldest unpublished deliveries (a top-k report)."""
    return reporting.pending_outbox(table(spark, d, "queue_outbox"), 20).select("delivery_no")


_TOP = "SELECT delivery_no FROM queue_outbox WHERE published_at IS NULL ORDER BY created_at, delivery_no LIMIT 20"


def file_listing(spark, d):
    """Files filtered by parameters, one of them not given."""
    rows = latest(table(spark, d, "files"), ["file_id"])
    return reporting.listing(rows, {"source_type": "local", "status": None}, {"file_name": "CARTA"}).select("file_id", "file_name")


_LISTING = f"WITH {_F} SELECT file_id, file_name FROM f WHERE source_type = 'local' AND lower(file_name) LIKE '%carta%'"

def chunks_per_page(spark, d):
    return reporting.chunks_per_page(table(spark, d, C_TABLE))


_PER_PAGE = f"WITH {_C} SELECT file_id, page_start, count(*) AS chunks FROM c GROUP BY ALL"


def file_progress(spark, d):
    return reporting.file_progress(table(spark, d, "files"), table(spark, d, P_TABLE))


_PROGRESS = f"""WITH {_P}, x AS (SELECT file_id, count(*) AS pages, count(*) FILTER (status = 'completed') AS completed FROM p GROUP BY 1)
SELECT f.file_id, coalesce(pages, 0) AS pages, coalesce(completed, 0) AS completed FROM (SELECT DISTINCT file_id FROM files) f LEFT JOIN x USING (file_id)"""


def latest_deliveries(spark, d):
    return reporting.latest_deliveries(table(spark, d, "queue_outbox"))


_DELIVERIES = """SELECT file_id, queue_name, status, attempts FROM queue_outbox
QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY created_at DESC, delivery_no DESC) = 1"""


def entities_per_chunk(spark, d):
    return reporting.entities_per_chunk(table(spark, d, C_TABLE), table(spark, d, E_TABLE))


_PER_CHUNK = f"""WITH {_E}, x AS (SELECT primary_location.chunk_id AS chunk_id, count(*) AS entities, count(DISTINCT entity_type) AS types FROM e GROUP BY 1)
SELECT c.chunk_id, coalesce(entities, 0) AS entities, coalesce(types, 0) AS types FROM (SELECT DISTINCT chunk_id FROM {C_TABLE}) c LEFT JOIN x USING (chunk_id)"""


QUERIES = {
    "chunks_per_page": (chunks_per_page, _PER_PAGE),
    "file_progress": (file_progress, _PROGRESS),
    "latest_deliveries": (latest_deliveries, _DELIVERIES),
    "entities_per_chunk": (entities_per_chunk, _PER_CHUNK),
    "norm_keys": (norm_keys, _NORM),
    "rut_values": (rut_values, _RUT),
    "email_values": (email_values, _EMAIL),
    "phone_values": (phone_values, _PHONE),
    "luhn_of_keys": (luhn_of_keys, _LUHN),
    "dates_of_orders": (dates_of_orders, _DATES),
    "small_values": (small_values, _SMALL),
    "canonical_types": (canonical_types, _TYPES),
    "email_spans": (email_spans, _EMAIL_SPANS),
    "rut_spans_valid": (rut_spans_valid, _RUT_SPANS),
    "term_hits": (term_hits, _TERM_HITS),
    "detected_counts": (detected_counts, None),
    "accepted_entities": (accepted_entities, None),
    "overlap_join": (overlap_join, _OVERLAP),
    "overlap_islands": (overlap_islands, _ISLANDS + " SELECT file_id, entity_id, CAST(island AS BIGINT) AS island FROM i"),
    "island_choice": (island_choice, _CHOICE),
    "greedy_kept": (greedy_kept, _GREEDY),
    "value_dedupe": (value_dedupe, _DEDUPE),
    "gated_entities": (gated_entities, _GATED),
    "base_values": (base_values, _BASE_VALUES),
    "entity_ids": (entity_ids, _IDS),
    "best_overlaps": (best_overlaps, _BEST),
    "header_types": (header_types, _HEADERS),
    "match_rates": (match_rates, _RATES),
    "match_rates_all": (match_rates_all, None),
    "column_findings": (column_findings, None),
    "findings_by_level": (findings_by_level, None),
    "findings_projection": (findings_projection, None),
    "route_files": (route_files, _ROUTE),
    "revision_keys": (revision_keys, _REVISION),
    "snapshot_states": (snapshot_states, _STATES),
    "tombstones": (tombstones, _TOMB),
    "snapshot_counters": (snapshot_counters, _COUNTERS),
    "page_routes": (page_routes, _PAGE),
    "document_chunks": (document_chunks, None),
    "document_blocks": (document_blocks, _BLOCKS),
    "chunk_offsets": (chunk_offsets, _OFFSETS),
    "chunk_reindex": (chunk_reindex, _REINDEX),
    "chunk_hashes": (chunk_hashes, _HASHES),
    "entity_summary": (entity_summary, _SUMMARY),
    "page_rollup": (page_rollup, _ROLLUP),
    "consecutive_scanned": (consecutive_scanned, _CONSECUTIVE),
    "entity_index": (entity_index, _INDEX),
    "latest_snapshots": (latest_snapshots, _LATEST),
    "run_overview": (run_overview, _OVERVIEW),
    "pending_outbox": (pending_outbox, _PENDING),
    "pending_top": (pending_top, _TOP),
    "file_listing": (file_listing, _LISTING),
}
