"""Spans of patterns and dictionary terms in text, with exact offsets.

Offsets are rebuilt inside the JVM: the pieces between the matches of a pattern
and the matches themselves add up to the text, so the start of match i is the
length of everything before it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cernido.functions import textnorm as tn
from cernido.functions import validators as v


@dataclass(frozen=True)
class Pattern:
    entity_type: str
    raw_type: str
    regex: str
    score: float
    group: int = 0


# The span patterns with their scores. A group ends where its match ends.
PATTERNS = (
    Pattern("RUT", "RUT_REGEX", v.RUT_PATTERN, 0.99),
    Pattern("EMAIL", "EMAIL_REGEX", v.EMAIL_PATTERN, 0.99),
    Pattern("PHONE_CL", "PHONE_CL_REGEX", v.PHONE_PATTERN, 0.95),
    Pattern("PAYMENT_CARD", "PAYMENT_CARD_REGEX", v.CARD_PATTERN, 0.99),
    Pattern("LICENSE_PLATE", "LICENSE_PLATE_REGEX", v.PLATE_PATTERN, 0.90),
    Pattern(
        "GENDER_IDENTITY", "GENDER_IDENTITY_CONTEXT_REGEX",
        r"(?iu)\b(?:sexo|g[eé]nero|identidad\s+de\s+g[eé]nero)\s*(?:[:=#-]|\bes\b)?\s*(H|M|F|hombre|mujer|masculino|femenino)\b",
        0.96, 1,
    ),
    Pattern(
        "DOCUMENT_NUMBER", "DOCUMENT_NUMBER_CONTEXT_REGEX",
        r"(?i)\b(?:numero\s+de\s+documento|num\.?\s+documento|documento|carnet)\s*(?:n[roº°]*\.?\s*)?[:#-]?\s*"
        r"(\d{1,3}(?:\.\d{3}){2,3}|\d{7,12})\b",
        0.88, 1,
    ),
    Pattern(
        "SECRET", "SECRET_CONTEXT_REGEX",
        r"(?i)\b(?:password|passwd|pwd|secret|api[_-]?key|access[_-]?token|bearer\s+token)\b\s*[:=]\s*([A-Za-z0-9_./+=-]{6,})",
        0.99, 1,
    ),
)

DENY_SCORE = 0.98

# The dictionary terms by entity type.
TERMS = {
    "HEALTH_SYSTEM": [
        "Banmedica S.A.", "Banmedica", "Isalud Ltda.", "Isalud", "Colmena Golden Cross S.A.", "Colmena Golden Cross",
        "Consalud S.A.", "Consalud", "Cruz Blanca S.A.", "Cruz Blanca", "Cruz del Norte Ltda.", "Cruz del Norte",
        "Nueva MasVida S.A.", "Nueva MasVida", "Fundacion Ltda.", "Fundacion", "Vida Tres S.A.", "Vida Tres",
        "Esencial S.A.", "Fonasa",
    ],
    "PENSION_SYSTEM": ["AFP Capital", "AFP Cuprum", "AFP Habitat", "AFP Modelo", "AFP Planvital", "AFP Provida", "AFP Uno"],
    "HEALTH_DATA": ["asma", "cancer", "diabetes", "hipertension", "leucemia", "vih", "sida", "depresion", "ansiedad"],
    "RELIGION_OR_BELIEF": [
        "agnostico", "agnostica", "agnosticismo", "ateo", "atea", "ateismo", "bahai", "catolico", "catolica", "cristiano",
        "cristiana", "cristianismo", "evangelico", "evangelica", "hindu", "hinduismo", "hinduista", "islam", "islamica",
        "islamico", "judio", "judia", "judaismo", "musulman", "musulmana", "budista", "budismo", "mormon", "mormona",
        "ninguna religion", "no tengo religion", "no tiene religion", "no profesa religion", "protestante",
        "religion catolica", "religion evangelica", "sij", "sin religion", "sikh", "testigo de jehova", "testigos de jehova",
    ],
    "SEXUAL_ORIENTATION": ["heterosexual", "homosexual", "bisexual", "gay", "lesbiana", "pansexual", "asexual"],
    "GENDER_IDENTITY": ["hombre", "mujer", "masculino", "femenino"],
    "MARITAL_STATUS": [
        "acuerdo de union civil", "anulado", "anulada", "casado", "casada", "con acuerdo de union civil", "conviviente",
        "conviviente civil", "divorciado", "divorciada", "pareja de hecho", "separado", "separada",
        "separado judicialmente", "separada judicialmente", "soltero", "soltera", "union civil", "union libre", "viudo",
        "viuda",
    ],
    "POLITICAL_OR_UNION_AFFILIATION": ["militante", "afiliado sindical", "sindicato", "partido politico"],
    "BIOMETRIC_OR_BIOLOGICAL": ["huella digital", "iris", "retina", "adn", "reconocimiento facial", "perfil biologico"],
}

SPAN = "struct<start_pos:int,end_pos:int,text:string>"


def spans_of(text: Column, regex: str, group: int = 0) -> Column:
    """array<struct<start_pos, end_pos, text>> of all matches, in order."""
    p = F.lit(regex)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    wanted = whole if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
    # bound to a lambda variable, so each is computed once a text
    parts = F.array(F.struct(whole.alias("w"), wanted.alias("m"), F.split(text, regex, -1).alias("p")))

    def place(b: Column) -> Column:
        def lengths(a: Column, n: Column) -> Column:
            return F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda s, x: s + F.length(x))

        def span(m: Column, i: Column) -> Column:
            end = lengths(b["p"], i + 1) + lengths(b["w"], i + 1)
            return F.struct((end - F.length(m)).alias("start_pos"), end.alias("end_pos"), m.alias("text"))

        return F.transform(b["m"], span)

    return F.when(text.rlike(regex), F.get(F.transform(parts, place), F.lit(0)))


def detected_value(kind: str, c: Column) -> Column:
    """The normalized value that a detector notes beside its span."""
    if kind in ("RUT", "LICENSE_PLATE", "PAYMENT_CARD", "DOCUMENT_NUMBER"):
        return F.upper(F.regexp_replace(c, "[^0-9KkA-Za-z]", ""))
    if kind == "PHONE_CL":
        d = F.regexp_replace(tn.digits_only(c), r"\A0056", "56")
        return F.when(F.startswith(d, F.lit("56")), F.concat(F.lit("+"), d)).when(F.length(d) == 9, F.concat(F.lit("+56"), d)).otherwise(d)
    if kind == "EMAIL":
        return F.lower(tn.trimmed(c))
    if kind == "GENDER_IDENTITY":
        return tn.gender(c)
    return tn.squeeze(c)


_NONE = f"array<{SPAN}>"


def _rows(spans: Column, kind: str, raw: str, source: str, score: float, text: str | None = None) -> Column:
    """Spans as structs of the output columns; their text cut from ``text`` if given."""

    def row(s: Column) -> Column:
        value = s["text"] if text is None else F.substring(F.col(text), s["start_pos"] + 1, s["end_pos"] - s["start_pos"])
        return F.struct(
            F.lit(kind).alias("entity_type"), F.lit(raw).alias("raw_entity_type"), F.lit(source).alias("source"), value.alias("span_text"),
            s["start_pos"].alias("start_pos"), s["end_pos"].alias("end_pos"), F.lit(score).alias("score"),
            detected_value(kind, value).alias("normalized_value"),
        )

    return F.transform(spans, row)


def pattern_spans(df: DataFrame, text: str = "text", patterns: tuple[Pattern, ...] = PATTERNS) -> DataFrame:
    """One row per span of every pattern beside the other columns of ``df``:
    entity_type, raw_entity_type, source, span_text, start_pos, end_pos, score,
    normalized_value. One pass over the text; a null text has none."""
    found = [
        _rows(F.coalesce(spans_of(F.col(text), p.regex, p.group), F.array().cast(_NONE)), p.entity_type, p.raw_type, "regex", p.score)
        for p in patterns
    ]
    return df.select("*", F.inline(F.concat(*found)))


def _term_regex(terms: list[str]) -> str:
    parts = [r"\s+".join(re.escape(w) for w in t.split()) for t in sorted(terms, key=lambda t: (-len(t), t))]
    return rf"(?<![0-9A-Za-z_])(?:{'|'.join(parts)})(?![0-9A-Za-z_])"


def term_levels(terms: list[str]) -> list[list[str]]:
    """Terms such that no term of a level is part of another of the same level:
    each level is one pattern, and all levels find what every term finds."""
    left, levels = sorted(set(terms)), []
    while left:
        inner = [t for t in left if any(t != o and re.search(rf"(?<!\w){re.escape(t)}(?!\w)", o) for o in left)]
        levels.append([t for t in left if t not in inner])
        left = inner
    return levels


def term_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per span of a dictionary term, as in ``pattern_spans``. Terms
    match without accents and case, as whole words, the longer and the shorter
    each; the same span of a type comes once."""
    low = F.lower(tn.without_marks(F.col(text)))
    parts = []
    for kind, terms in TERMS.items():
        levels = [spans_of(low, _term_regex(level)) for level in term_levels([t.lower() for t in terms])]
        spans = F.array_distinct(F.concat(*[F.coalesce(s, F.array().cast(_NONE)) for s in levels]))
        parts.append(_rows(spans, kind, f"{kind}_DENY_LIST", "deny_list", DENY_SCORE, text))
    return df.select("*", F.inline(F.concat(*parts)))


def detect(df: DataFrame, text: str = "text", *models: DataFrame) -> DataFrame:
    """Union of all detectors without resolving overlaps. ``models`` are frames
    of spans from external models with the same columns."""
    found = pattern_spans(df, text).unionByName(term_spans(df, text))
    for m in models:
        found = found.unionByName(m, allowMissingColumns=True)
    return found
