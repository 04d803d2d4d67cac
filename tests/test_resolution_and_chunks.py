from __future__ import annotations

import random

from pyspark.sql import functions as F

from cernido.operators import chunking, discovery, resolution
from cernido.operators.chunking import Sizes, page_chunks

SPAN = (
    "file_id string, chunk_id string, chunk_index int, entity_type string, raw_entity_type string, source string, span_text string,"
    " start_pos int, end_pos int, score double, normalized_value string"
)


def span(kind, raw, text, start, score=0.99, source="regex", chunk="c1", index=1):
    return ("f", chunk, index, kind, raw, source, text, start, start + len(text), score, None)


def test_base_beats_overlap_and_keeps_its_evidence(spark):
    rows = [span("RUT", "RUT_REGEX", "12.378.895-8", 0), span("ID", "ID", "378.895-8", 3, 0.99, "presidio"), span("RUT", "RUT_REGEX", "12.378.895-9", 40),
            span("RUT", "RUT_REGEX", "12378895-8", 5, chunk="c2", index=2)]
    got = resolution.resolve(spark.createDataFrame(rows, SPAN)).collect()
    assert len(got) == 1
    assert got[0].normalized_value == "12.378.895-8" and len(got[0].evidence) == 3 and got[0].entity_index == 0 and len(got[0].entity_id) == 16


def test_gates_and_scorer(spark):
    rows = [span("DOCUMENT_NUMBER", "X", "123456789", 0, 0.90), span("USERNAME", "X", "pepe", 20, 0.91), span("AGE", "X", "145", 30), span("AGE", "X", "45", 40, 0.1),
            span("PERSON", "P", "Ana Paz", 50, 0.5), span("PERSON", "P", "Luz", 70, 0.49), span("URL", "U", "a.cl", 90, 0.9)]
    df = spark.createDataFrame(rows, SPAN)
    assert {r.text for r in resolution.resolve(df).collect()} == {"pepe", "45"}
    scorer = lambda d: d.withColumn("model_score", F.lit(0.86))
    got = {r.text: r.confidence_level for r in resolution.resolve(df, scorer).collect()}
    assert got == {"pepe": "PROBABLE", "45": "PROBABLE", "Ana Paz": "CONFIDENT"}


def test_dictionary_gender_takes_the_place_of_the_context_pattern(spark):
    rows = [span("GENDER_IDENTITY", "GENDER_IDENTITY_CONTEXT_REGEX", "mujer", 6, 0.99), span("GENDER_IDENTITY", "GENDER_IDENTITY_DENY_LIST", "mujer", 6, 0.98, "deny_list")]
    got = resolution.resolve(spark.createDataFrame(rows, SPAN)).collect()
    assert [(r.raw_entity_type, len(r.evidence)) for r in got] == [("GENDER_IDENTITY_DENY_LIST", 2)]


def test_greedy_equals_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for c in range(20):
        for _ in range(rng.randrange(1, 12)):
            rows.append(span("USERNAME", "X", "a" * rng.randrange(1, 9), rng.randrange(30), rng.randrange(91, 99) / 100, chunk=f"c{c}", index=c))
    df = resolution.ranked(resolution.gated(resolution.candidates(spark.createDataFrame(rows, SPAN))).drop("rank"))
    got = {(r.chunk_id, r.rank) for r in resolution.greedy(df).filter("rank = owner").collect()}
    want = set()
    by = {}
    for r in sorted(df.collect(), key=lambda r: (r.chunk_id, r["rank"])):
        kept = by.setdefault(r.chunk_id, [])
        if all(max(a, r.start_pos) >= min(b, r.end_pos) for a, b in kept):
            kept.append((r.start_pos, r.end_pos))
            want.add((r.chunk_id, r["rank"]))
    assert got == want


def blocks(*lengths):
    return [(f"b{i}", 1, i, "x" * n) for i, n in enumerate(lengths)]


def test_chunk_tails():
    assert [len(c["text"]) for c in page_chunks(blocks(800, 100), Sizes(700, 1000, 400, 0))] == [901]
    assert [len(c["text"]) for c in page_chunks(blocks(350, 350, 100), Sizes(650, 750, 400, 0))] == [350, 451]
    cut = page_chunks([("b", 1, 0, "ab cd ef")], Sizes(4, 5, 2, 3))
    assert all(len(s["source_block_id"]) for c in cut for s in c["segments"])


def test_chunks_map_back_to_their_blocks(spark):
    rng = random.Random(3)
    texts = {i: " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 300))) for i in range(12)}
    rows = [("f", 1 + i // 4, i, f"b{i}", t) for i, t in texts.items()] + [("f", 9, 0, "blank", " \n ")]
    df = spark.createDataFrame(rows, "file_id string, page_number int, block_index int, source_block_id string, text string")
    got = chunking.build_chunks(df, Sizes(300, 500, 80, 40)).orderBy("chunk_index").collect()
    assert [r.chunk_index for r in got] == list(range(1, len(got) + 1))
    for r in got:
        assert len(r.text) <= 500 + 300 + 41
        for s in r.segments:
            assert r.text[s.chunk_text_start : s.chunk_text_end] == texts[int(s.source_block_id[1:])][s.source_text_start : s.source_text_end]


def test_discovery_finds_and_passes_on(spark):
    people = spark.createDataFrame([(i, f"p{i}@example.com", "12.378.895-8") for i in range(5)], "id int, correo string, rut string")
    pay = spark.createDataFrame([(1, "?", 7.5)], "id int, rut string, monto double")
    got = {(r.table_name, r.column_name): (r.pii_type, r.confidence_level, r.detection_method) for r in discovery.discover({"people": people, "pay": pay}, "2026-01-01").collect()}
    assert got[("people", "correo")] == ("EMAIL", "VERY_CONFIDENT", "header_and_value")
    assert got[("people", "rut")] == ("RUT", "VERY_CONFIDENT", "header_and_value")
    assert got[("pay", "rut")] == ("RUT", "CONFIDENT", "propagated_column_name")
    assert ("people", "id") not in got


def test_match_rates_skip_only_cells_that_no_check_accepts(spark):
    from pyspark.sql import functions as F

    from cernido.functions import validators as v
    from cernido.functions.textnorm import sample_value, tabular_key
    from cernido.operators import discovery

    texts = [
        None, "", "  \t", "12.345.678-5", " 7.654.321-6 ", "4111 1111 1111 1111", "a@b.cl", "á@b.cl", "+56 9 8765 4321", "0056212345678", "ABCD12", "AB-CD-12", "1/2/20",
        "2020-02-30", "1999-12-31T10:00", "F", " m.", "Otro", "No  binario", "Banmédica S.A.", "capital", "3 de marzo de 1999", "Marzo 3rd, 99", "3 Énero 2001",
        "Av. Sol 12", "avenido 12", "Población 4", "a" * 24, "z" * 32, "z" * 31 + " ", "x " * 200 + "calle 1", "1" + " " * 300 + "z",
    ]
    rows = [(t, n, x, b) for t, n, x, b in zip(texts, [4111111111111111, 987654321, -987654321, 5, None] * 7, [9876543.25, 95432.15, float("nan"), 2.0, 1e30] * 7, [True, None] * 16)]
    df = spark.createDataFrame(rows, "text string, amount bigint, price double, ok boolean").withColumn("day", F.expr("DATE '1899-12-30' + cast(coalesce(amount, 1) % 7 AS int)"))
    df = df.withColumn("at", F.col("day").cast("timestamp")).repartition(1)
    assert discovery.cells(df, {"amount": 0, "ok": 1, "day": 2, "at": 3}).count() == sum(r[1] is not None and r[1] >= 200_000_000 for r in rows)
    got = {(r.column_name, r.entity_type): (r.matched, r.sampled) for r in discovery.match_rates({"t": df}, {"t": discovery.profile_of(df, "t")}, "2026-01-01").collect()}
    for name in df.columns:
        c = sample_value(F.col(name))
        want = {
            "RUT": v.rut_in_table(c), "PAYMENT_CARD": v.card_in_table(c), "EMAIL": v.email_in_table(c), "PHONE_CL": v.phone_in_table(c), "LICENSE_PLATE": v.plate_in_table(c),
            "DATE": F.when(v.full_match(c, v.DATE_PATTERN), v.date_in_table(c, "2026-01-01")), "TEXT_DATE": v.worded_date_in_table(c, "2026-01-01"),
            "ADDRESS_VALUE": F.nullif(v.address(c, tabular_key(c)), F.lit(False)), "TECHNICAL": F.nullif(v.technical(c), F.lit(False)),
            **{k: F.nullif(v.in_catalog(k, c, F.lit(False)), F.lit(False)) for k in v.CATALOGS},
        }
        row = df.agg(F.count(c).alias("n"), *[F.count(x).alias(k) for k, x in want.items()]).first()
        assert {k: got[name, k] for k in want} == {k: (row[k], row.n) for k in want}, name
    assert got["price", "PHONE_CL"][0] == 7 and got["text", "RUT"][0] > 0 and got["text", "TEXT_DATE"][0] > 1
