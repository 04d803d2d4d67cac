from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cernido.functions import spans, textnorm as tn, validators as v
from cernido.functions.spans import PATTERNS

TODAY = "2026-01-01"


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_national_ids(spark):
    assert values(spark, v.rut, ["12.378.895-8", "12378895-8", "1.000.005-k", "12.378.895-9", "123788958", "", None]) == [
        "12.378.895-8", "12.378.895-8", "1.000.005-K", None, "12.378.895-8", None, None,
    ]
    assert values(spark, v.rut_in_table, ["12.378.895-8", "123788958"]) == ["12.378.895-8", None]


def test_cards_mails_phones(spark):
    assert values(spark, v.card, ["4111 1111 1111 1111", "1111 1111 1111 1111", "4012 0010 3714 1113"]) == ["4111111111111111", None, None]
    assert values(spark, v.email, ["Persona@Example.COM", "persona@example", "persona @example.com", "a@b..c", None]) == ["Persona@example.com", None, None, None, None]
    assert values(spark, v.phone, ["+56 9 1234 5678", "2 2345 6789", "0056 2 2345 6789", "912345678", "233171252"]) == [
        "+56912345678", None, "+56223456789", "+56912345678", None,
    ]


def test_dates(spark):
    table = values(spark, lambda c: v.date_in_table(c, TODAY).cast("string"), ["31/12/69", "12/31/1969", "1969-12-31 00:00:00", "1.1.05", "31/02/2020", "01/01/2100", None])
    assert table == ["1969-12-31", "1969-12-31", "1969-12-31", "2005-01-01", None, None, None]
    worded = values(spark, lambda c: v.worded_date_in_table(c, TODAY).cast("string"), ["31 de Diciembre de 1969", "31 de NoExiste de 1969", "march 3rd 1990"])
    assert worded == ["1969-12-31", None, "1990-03-03"]
    text = values(spark, v.date_in_text, ["31/12/25", "31/12/31", "2 de enero de 2099", "2 setiembre 99", "30/2/2020", "2020-2-29 10:30"])
    assert text == ["2025-12-31", "1931-12-31", "2099-01-02", "1999-09-02", None, "2020-02-29"]


def test_small_validators(spark):
    assert values(spark, v.age, ["45", "145", "x"]) == ["45", None, None]
    assert values(spark, v.mac, ["aa:bb:cc:dd:ee:ff", "aabb.ccdd.eeff", "aa:bb-cc:dd:ee:ff"]) == ["AA:BB:CC:DD:EE:FF", "AA:BB:CC:DD:EE:FF", None]
    assert values(spark, v.plate, ["JV-TG-56", "ab1234", "ABC"]) == ["JVTG56", "AB1234", None]
    assert values(spark, v.address, ["Av. Siempre Viva 742", "Av. Siempre Viva"]) == [True, False]
    assert values(spark, v.url, ["example.com/x", "ftp://a.b", "nohost", "http://.a"]) == ["example.com/x", "ftp://a.b", None, None]
    assert values(spark, v.ip, ["10.0.0.1", "300.1.1.1", "2001:0DB8:0:0:0:0:0:0001"]) == ["10.0.0.1", None, "2001:db8:0:0:0:0:0:1"]


def test_normalizers(spark):
    assert values(spark, tn.text_key, ["  Straße   X ", None]) == ["strasse x", None]
    assert values(spark, tn.tabular_key, ["Ñandú, Ltda."]) == ["nandu ltda"]
    assert values(spark, tn.identifier, ["  Fecha Nac. ", None]) == ["fecha_nac", ""]
    assert values(spark, tn.masked, ["ab", "abcd", ""]) == ["**", "a**d", ""]
    assert values(spark, tn.gender, ["M", "hombre", "Mujer", "otro"]) == ["masculino", "masculino", "femenino", "otro"]
    assert values(spark, lambda c: tn.canonical_type(c, F.lit("")), ["GLINER2_FULL_NAME", "RUT_REGEX", "GENDER_IDENTITY_CONTEXT_REGEX", "IBAN_CODE", "odd"]) == [
        "NAME", "RUT", "GENDER", "BANK_ACCOUNT", "ODD",
    ]
    assert values(spark, tn.without_secrets, ["https://u:p@h.cl?token=abc&x=1"]) == ["https://***@h.cl?token=***&x=1"]


PARTS = st.sampled_from(["12.378.895-8", "a@b.cl", "a@b.cl.", "+56 9 1234 5678", "4111 1111 1111 1111", "JVTG56", "sexo: M", " ", "x", "\n", "carnet 12345678", "pwd=secreto1"])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=8).map("".join), min_size=1, max_size=8))
def test_spans_have_the_offsets_of_the_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = sorted((r.i, r.raw_entity_type, r.start_pos, r.end_pos) for r in spans.pattern_spans(df).collect())
    want = sorted((i, p.raw_type, *m.span(p.group)) for i, t in enumerate(texts) for p in PATTERNS for m in re.finditer(p.regex, t))
    assert got == want


def test_terms_longer_and_shorter(spark):
    df = spark.createDataFrame([("Está SEPARADO  judicialmente, Cruz Blanca S.A. viudos",), (None,)], "text string")
    got = {(r.entity_type, r.span_text) for r in spans.term_spans(df).collect()}
    assert got == {
        ("MARITAL_STATUS", "SEPARADO  judicialmente"), ("MARITAL_STATUS", "SEPARADO"), ("HEALTH_SYSTEM", "Cruz Blanca"), ("HEALTH_SYSTEM", "Cruz Blanca S.A."),
    }
