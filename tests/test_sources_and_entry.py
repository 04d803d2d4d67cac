from __future__ import annotations

import io
import os
import zipfile

import pytest

from cernido.sources import databases, files
from cernido.streaming.messages import dead_letters, drain, judged, read_stream

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
R = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def packed(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_csv_headers_blank_rows_and_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿email,,rut\na@b.cl,1,x\n,,\nñ@b.cl,2,y\n".encode())
    df = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["email", "column_2", "rut"] and df.count() == 2
    (tmp_path / "b.csv").write_bytes("nombre\nMuñoz\n".encode("latin-1"))
    assert files.read_csv(spark, str(tmp_path / "b.csv")).first()[0] == "Muñoz"
    (tmp_path / "set").mkdir()
    (tmp_path / "set" / "a.csv").write_bytes("n,t\nMuñoz,\"a\nñ\"\n".encode())
    (tmp_path / "set" / "b.csv").write_bytes("n,t\nPeña,\n,\n".encode("latin-1"))
    (tmp_path / "set" / "c.csv").write_bytes("\ufeffn,t\nÑuble,x\n".encode())
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path / "set")).collect()} == {("Muñoz", "a\nñ"), ("Peña", None), ("Ñuble", "x")}


def test_word_and_sheet_files(spark, tmp_path):
    doc = f"<w:document {W}><w:body><w:p><w:r><w:t>Uno</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p/></w:body></w:document>"
    (tmp_path / "x.docx").write_bytes(packed({"word/document.xml": doc}))
    (tmp_path / "y.docx").write_bytes(b"broken")
    got = {(r.path[-6:], r.block_type, r.text, r.error is None) for r in files.read_docx(spark, str(tmp_path / "*.docx")).collect()}
    assert got == {("x.docx", "paragraph", "Uno", True), ("x.docx", "table", "a | b", True), ("y.docx", None, None, False)}
    book = {
        "xl/workbook.xml": f'<workbook {S} {R}><sheets><sheet name="A" r:id="r1"/><sheet name="B" state="hidden" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="worksheets/s1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {S}><si><t>rut</t></si></sst>",
        "xl/worksheets/s1.xml": f'<worksheet {S}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row></sheetData></worksheet>',
    }
    (tmp_path / "z.xlsx").write_bytes(packed(book))
    assert [(r.sheet, r.row, r.cells) for r in files.read_xlsx(spark, str(tmp_path / "z.xlsx")).collect()] == [("A", 1, ["rut", "", "5"])]


def test_texts_html_and_listing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.TXT").write_bytes("á".encode("latin-1"))
    assert files.read_texts(spark, str(tmp_path / "d" / "a.TXT")).first().text == "á"
    assert [r.extension for r in files.list_folder(spark, str(tmp_path)).collect()] == [".txt"]
    assert files.html_text("<p> a &amp; b </p><b>c</b>") == "a & b c" and files.html_text(None) is None


def test_guard_looks_past_quotes(spark):
    got = databases.guarded_sql(spark, "SELECT 1 AS `update`, 'drop table x; --' AS s -- delete from t\n").first()
    assert got["update"] == 1 and got["s"] == "drop table x; --"
    for bad in ("WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "SELECT 1; SELECT 2", "DROP TABLE t"):
        with pytest.raises(ValueError):
            databases.guarded_sql(spark, bad)


def test_guard_and_paged_service(spark):
    assert databases.guarded_sql(spark, "SELECT 1 AS x;").first().x == 1
    for bad in ("DROP TABLE x", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) DELETE FROM a"):
        with pytest.raises(ValueError):
            databases.guarded_sql(spark, bad)

    def fetch(statement, offset, limit):
        import json

        return json.dumps({"items": [{"n": i} for i in range(offset, min(offset + limit, 25))]})

    assert databases.read_pages(spark, "q", fetch, 25, 10, "n int").count() == 25


def test_paged_service_that_gives_fewer_rows(spark):
    def capped(rows, cap, stuck=False):
        def fetch(statement, offset, limit):
            import json

            n = 0 if stuck and offset else min(limit, cap)
            return json.dumps({"items": [{"n": i} for i in range(offset, min(offset + n, rows))], "hasMore": offset + n < rows})

        return fetch

    def read(*args, **more):
        return sorted(r.n for r in databases.read_pages(spark, "q", *args, "n int", **more).collect())

    assert read(capped(25, 4), 25, 10) == list(range(25))
    assert read(capped(33, 4), 25, 10) == list(range(33))  # rows that came after the count
    assert read(capped(17, 4), 25, 10) == list(range(17))  # rows that went
    assert read(capped(0, 4), 0, 10) == []
    with pytest.raises(Exception, match="gave none at offset"):
        read(capped(25, 4, stuck=True), 10, 10)
    with pytest.raises(Exception, match="more than 2 pages"):
        read(capped(25, 4), 25, 10, max_pages=2)


def test_contracts_and_drain(spark, tmp_path):
    rows = [("r", "f", '{"event_type": "file.routed", "file_id": "f", "attempt": 1}'), ("r", "f", "no json"), ("r", "f", None), ("r", "g", '{"event_type": "file.routed", "file_id": "f", "attempt": 1}')]
    df = spark.createDataFrame(rows, "run_id string, file_id string, payload string")
    assert sorted(str(r.problem) for r in judged(df).collect()) == ["None", "file_mismatch", "malformed_payload", "malformed_payload"]
    assert {(r.problem, r.deliveries) for r in dead_letters(df).collect()} == {("malformed_payload", 2), ("file_mismatch", 1)}
    df.withColumnRenamed("payload", "p").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = read_stream(spark, str(tmp_path / "in"), "run_id string, file_id string, p string")
        drain(stream, str(tmp_path / "out"), str(tmp_path / "state"), "p").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not here")
def test_registered_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(d):
        con.execute(f"CREATE VIEW {name[:-8]} AS FROM '{d}/{name}'")
    runs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(runs)
    for name in ("p2_found", "p5_found", "p7_found", "route_files", "greedy_kept", "entity_summary", "page_rollup", "tombstones"):
        df = runs[name](spark, d)
        cols = sorted(df.columns)
        got = sorted(repr([r[c] for c in cols]) for r in df.collect())
        cursor = con.execute(sqls[name])
        have = [x[0] for x in cursor.description]
        want = sorted(repr([row[have.index(c)] for c in cols]) for row in cursor.fetchall())
        assert sorted(have) == cols and got == want, name


def test_all_checks_are_registered_over_all_tables(spark):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    if not os.path.exists(d):
        pytest.skip("test data not here")
    rows = entry.queries()["match_rates_all"](spark, d).collect()
    assert {r.table_name for r in rows} == {n.removesuffix(".parquet") for n in os.listdir(d)}
    assert len({r.entity_type for r in rows}) > 4 and max(r.matched for r in rows if r.table_name == "text_extraction_pages") > 0
    some = {(r.table_name, r.column_name, r.entity_type): (r.matched, r.sampled) for r in rows}
    assert all(some[r.table_name, r.column_name, r.entity_type] == (r.matched, r.sampled) for r in entry.queries()["match_rates"](spark, d).collect())
