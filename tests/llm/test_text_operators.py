from __future__ import annotations

import datetime as dt
import math
import os
import random
import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cernido.llm import leakage, lookalike, personal, scanned, split, tokenize, truncation

VOCABULARY = f"{tokenize.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
here = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="vocabulary not here")
TIME = dt.datetime(2024, 1, 1)


def slow_merge(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@here
@settings(max_examples=60, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab ñ中🙏‍", max_size=200)))
def test_merges_equal_brute_force_and_decode(text):
    encoder = _encoder()
    ids = encoder.encode(text)
    back = {i: b for b, i in encoder.ranks.items()}
    assert b"".join(back[i] for i in ids).decode() == text
    want = [i for piece in encoder._split(text) for i in slow_merge(piece.encode(), encoder.ranks)]
    assert ids == want


_ENCODERS = []


def _encoder():
    if not _ENCODERS:
        _ENCODERS.append(tokenize.Encoder(VOCABULARY))
    return _ENCODERS[0]


@here
def test_encoding_equals_the_public_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = _encoder().ranks
    other = tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hola  mundo\n\n", "aaaa" * 3000, "🙏🙏<|endoftext|>", " x", "x" * 5 + "\t\t  y"]
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in tokenize.encode_corpus(rows).collect()}
    assert got == {i: other.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert tokenize.encode_corpus(rows.limit(0)).count() == 0


def test_lookalikes():
    same = ["Тоrо", "Toro", "Ｔｏｒｏ", "To​ro", "Тoрo".replace("р", "r")]
    assert {lookalike.skeleton(s) for s in same} == {"Toro"}
    assert lookalike.skeleton("é") == lookalike.skeleton("é") != lookalike.skeleton("e")
    assert lookalike.skeleton("A") != lookalike.skeleton("a") and lookalike.skeleton(None) is None
    assert lookalike.skeleton("Ꭺnıta τом") == lookalike.skeleton("Anita тоm".replace("m", "м")) and lookalike.skeleton("Il1O0") == "Il1O0"
    assert lookalike.canonical("Юлия") == "Юлия" and lookalike.canonical("νόμος Ꭺna") == "νόμος Ana" and lookalike.canonical("x²½") == "x²½"


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aeé́̃ñ한ᅡﬁ１ ， x", max_size=20))
def test_spliced_segments_equal_the_whole(text):
    whole = "".join(lookalike._fold(c) for c in unicodedata.normalize("NFC", text))
    whole = unicodedata.normalize("NFC", unicodedata.normalize("NFD", unicodedata.normalize("NFC", whole)).translate(lookalike.known_looks().letters))
    assert lookalike.skeleton(text) == whole.strip()


def test_same_look_pairs(spark):
    rows = [("f", "1", "N", "Toro", TIME), ("f", "2", "N", "Tоro", TIME), ("f", "3", "N", "Toro", TIME), ("f", "4", "M", "Tоro", TIME), ("g", "5", "N", "Tоro", TIME),
            ("f", "6", "N", None, TIME), ("f", "2", "N", "old", None)]
    df = spark.createDataFrame(rows, "file_id string, entity_id string, entity_type string, text string, updated_at timestamp")
    assert {tuple(r) for r in lookalike.same_look_pairs(df).collect()} == {("f", "1", "2"), ("f", "2", "3")}
    assert lookalike.same_look_pairs(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n", min_size=0, max_size=900), st.integers(20, 200), st.integers(0, 60))
def test_pieces_cover_the_text_within_the_limit(text, most, overlap):
    pieces = split.split_text(text, most, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(b - a <= most for a, b in pieces)
    assert all(x[1] >= y[0] > x[0] and y[1] > x[1] for x, y in zip(pieces, pieces[1:]))


def test_cuts_fall_on_boundaries_and_stay_after_edits():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 9))) + rng.choice(["", "", "."]) for _ in range(2000))
    ends = [text[a:b] for a, b in split.split_text(text, 600, 60)]
    assert all(p.endswith((" ", ". ")) for p in ends[:-1])
    edited = split.split_text("inserted words " + text, 600, 60)
    again = {("inserted words " + text)[a:b] for a, b in edited}
    assert len(set(ends[3:]) & again) >= len(ends) - 5


def test_leaks_whole_partial_and_changed(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.sample(words, 60))) for i in range(12)]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = items[3][1].split()
    part, changed, short = passage[10:30], passage[5:45], passage[:9]
    for k in (4, 14, 24, 34):
        changed[k] = "CHANGED"
    docs = [(1, noise(40) + " " + items[5][1].upper() + "! " + noise(9)), (2, noise(30) + " " + ", ".join(part) + noise(20)), (3, " ".join(changed)),
            (4, noise(20) + " " + " ".join(short) + " " + noise(20)), (5, None), (6, ""), (7, noise(3000))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame(items + [(99, None)], "item_id long, passage string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaked(d, t).collect()} == {(1, 5), (2, 3), (3, 3)}
    assert leakage.leaked(d, t.limit(0)).count() == 0 and leakage.leaked(d.limit(0), t).count() == 0


@pytest.mark.parametrize(("left", "run", "right"), [(9, 3, 9), (4, 3, 14), (14, 3, 4), (12, 4, 12), (14, 5, 14)])
def test_runs_of_added_and_missing_words(left, run, right):
    item = [f"w{i}" for i in range(60)]
    index = leakage.Index.build([(1, " ".join(item))])
    noise = [f"x{i}" for i in range(40)]
    added = noise[:15] + item[5 : 5 + left] + noise[20 : 20 + run] + item[5 + left : 5 + left + right] + noise[25:]
    missing = noise[:15] + item[5 : 5 + left] + item[5 + left + run : 5 + left + run + right] + noise[15:]
    assert [x[1:3] for x in index.leaks(added)] == [(left + right, run)]
    assert [x[1:3] for x in index.leaks(missing)] == [(left + run + right, run)]
    assert not index.leaks(noise[:15] + item[5:14] + noise[15:18] + item[30:34] + noise[18:])


def test_a_better_item_owns_only_what_it_clearly_fits_better():
    rng = random.Random(5)
    a, b = [[f"{c}{i}" for i in range(60)] for c in "ab"]
    other = [f"x{i}" for i in range(200)]

    def alike(changed, n=18):
        """An item that holds n words of a with some changed, among its own words."""
        part = a[20 : 20 + n]
        for k in changed:
            part[k] = f"c{k}"
        return b[:20] + part + b[20:]

    def found(text, item):
        index = leakage.Index.build([(1, " ".join(a)), (2, " ".join(item)), (3, " ".join(other))])
        return {x[0] for x in index.leaks(text)}

    noise = [rng.choice(other) for _ in range(30)]
    assert found(a, alike([5, 9, 13])) == {1}  # clearly worse, and nowhere else
    assert found(a, alike([9])) == {1, 2}  # about as good
    assert found(a + noise + b[30:46], alike([5, 9, 13])) == {1, 2}  # also elsewhere, in a shorter stretch
    assert found(a[:30] + noise, a[:30] + b) == {1, 2}


PAGES = "file_id string, page_number int, method string, updated_at timestamp"
CHUNKS = "chunk_id string, file_id string, chunk_index int, page_start int, page_end int, text string, method string, updated_at timestamp"


def test_scanning_noise(spark):
    prose = "La oficina de partes registró el informe mensual. El taller revisó las carpetas de la oficina."
    rows = [(f"c{i}", "clean", i, 1, 1, prose, "doc", TIME) for i in range(300)]
    rows += [
        ("s1", "f", 1, 1, 1, "Corporación Azul | Red Norte\nLa oficina de partes regis-\ntró el informe.\n— 5 —", None, TIME),
        ("s2", "f", 2, 1, 1, "corporación azul | red norte el taller revisó las carpctas de la 0ficina. página 3 de 9", "doc", TIME),
        ("s3", "f", 3, 1, 1, "Corporación Azul | Red Norte\nEl informe. Véase la página 69 de 223 del expediente.", "ocr", TIME),
        ("s4", "f", 4, 2, 2, "El taller revisó las carpctas.", "ocr", TIME), ("s5", "f", 5, 1, 1, None, "ocr", TIME), ("s6", "f", 6, 1, 1, "", "ocr", TIME),
        ("s1", "f", 1, 1, 1, "old carpctas", None, None),
    ]
    pages = [("f", 1, "ocr", TIME), ("f", 1, "doc", None), ("f", 2, "doc", TIME), ("clean", 1, "doc", TIME)]
    c, p = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(pages, PAGES)
    got = {(r.chunk_id, r.noise_kind) for r in scanned.found_noise(c, p).collect()}
    assert got == {("s1", "hyphen"), ("s1", "page_no"), ("s1", "header"), ("s2", "misread"), ("s2", "page_no"), ("s2", "header"), ("s3", "header")}
    mended = {r.chunk_id: r.text for r in scanned.repaired(c, p).collect()}
    assert mended["s1"] == "La oficina de partes registró el informe."
    assert mended["s2"] == "el taller revisó las carpetas de la oficina."
    assert scanned.found_noise(c.limit(0), p).count() == 0


def test_short_words_with_digits_are_misread():
    words = {w: 50 for w in "por los del ira bis oficina pasa taller".split()}
    model = scanned.Model(words, {("taller", "por"): 20, ("por", "los"): 20}, 10_000)
    assert model.misread("El taller p0r 1os de1 taller.", apply=True) == ("El taller por los del taller.", 3)
    assert scanned.noise_kinds("Pasa (p0r) oficina", model) == ["misread"]
    for kept in ("la 1ra oficina", "fa/de1+a0/p0r+bb", "mi-de1 x1", "pasa p07 x", "ana@de1.cl"):
        assert model.misread(kept, apply=True) == (kept, 0)


def test_words_of_any_length_and_bare_page_numbers():
    words = {w: 50 for w in "el sol del mes extraordinariamentelargoprofesionalmente en la nómina hasta nuevo aviso observatorio plan".split()}
    model = scanned.Model(words, {}, 10_000)
    assert model.misread("e1 5ol de1 me5", apply=True) == ("el sol del mes", 4)
    long = "extra0rdinariamente1argopr0fesi0na1mente"
    assert model.misread(long, apply=True)[0] == "extraordinariamentelargoprofesionalmente"
    assert model.mend_divided("la nómina\nen el observato- rio") == ("la nómina\nen el observatorio", 1)
    for text, page in (("12\nEl sol.", True), ("El plan del mes.\n7", True), ("la nómina hasta\n47\nnuevo aviso", True), ("El plan.\n361\n343\n252", False),
                       ("tel. +56 9 0732\n1934", False), ("calle Sol 1017, block\n9\n\nEl", False), ("Av. Sol\n55\n\n", False), ("al 56\n9\n0547", False)):
        assert bool(scanned.page_numbers(text)) == page, text
    assert scanned.repair("la nómina hasta\n47\nnuevo aviso", model) == "la nómina hasta nuevo aviso"


def test_a_run_of_many_signs_without_blanks_is_read_once():
    """A search from the run's start for each sign takes the square of its length."""
    started = time.process_time()
    assert scanned.anchors("sol " + "aB8fe0c2d/" * 4000 + " Red | Norte, folio n° 12") == {"red | norte": None, "folio 12": None}
    assert time.process_time() - started < 2


def test_equal_cases_are_decoded_once(monkeypatch):
    cases, decode = [], scanned.Model.decode
    monkeypatch.setattr(scanned.Model, "decode", lambda self, *case: cases.append(case) or decode(self, *case))
    model = scanned.Model({w: 50 for w in "el sol del mes".split()}, {("el", "sol"): 20}, 10_000)
    text = "\n".join(f"x{i} el 5ol del mes" for i in range(40))
    assert model.misread(text, apply=True) == (text.replace("5ol", "sol"), 40)
    assert len(cases) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["5ol", "e1", "del", "me5", "mes", "zz", "7a", "q9x9", None]), min_size=3, max_size=12))
def test_decoding_known_cases_changes_nothing(some):
    model = scanned.Model({w: 50 for w in "el sol del mes cel".split()}, {("el", "sol"): 20, ("del", "mes"): 30}, 10_000)
    before, *read, after = some
    read = [w for w in read if w]
    assert model.decode_known(read, before, after) == model.decode(read, before, after) == model.decode_known(read, before, after)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["sol", "n", "N", "º", "°", "a.b", "x_1", "²", "12", "3-4", " ", "\t", "\n", "\xa0", "-", "\xad", "¬", "|", "/", "é"]), max_size=14).map("".join))
def test_anchors_and_divided_words_are_those_of_plain_patterns(text):
    letter = r"[^\W\d_]"
    assert scanned._without_divided(text) == re.sub(rf"{letter}+(?:[{scanned._HYPHEN}]\s+|\xad){letter}+", " ", text)
    found = set()
    for m in scanned._SIGN.finditer(text):
        a, b = re.search(r"([\w.]+)[ \t]+\Z", text[: m.start()]), scanned._WORD_AFTER.match(text, m.end())
        if a and b and not (a[1].isdigit() and b[1].isdigit()):
            found.add(f"{a[1]} {m[0]} {b[1]}".translate(scanned._FOLD))
    for m in scanned._NUMBER.finditer(text):
        a = re.search(r"(\w+)[ \t]+(?:n[°º][ \t]*)?\Z", text[: m.start()], re.I)
        if a and not a[1].isdigit():
            found.add(f"{a[1]} {m[0]}".translate(scanned._FOLD))
    assert set(scanned.anchors(text)) == found


def test_the_channel_is_estimated_from_aligned_words(spark):
    model = scanned.Model({"oficina": 100, "sol": 50}, {}, 1000)
    read = spark.createDataFrame([("oficina", 1000), ("0ficina", 100), ("oflcina", 10), ("zzz", 9)], "b string, n long")
    channel = scanned.estimate_channel(read, model)
    assert math.exp(channel["0", "o"]) == pytest.approx(100 / 1100, rel=0.1) and math.exp(channel["l", "i"]) == pytest.approx(10 / 2010, rel=0.1)
    assert channel["0", "o"] > channel["l", "i"] > channel["5", "s"]


def test_headers_of_hot_files_and_on_few_chunks(spark):
    """(file, anchor): chunks with it. The hot file has a third of all chunks."""
    sizes = {"hot": 1000, "small": 12, "long": 30, "letter": 4} | {f"other{i}": 20 for i in range(5)} | {f"f{i}": 5 for i in range(400)}
    on = {("hot", "red | norte"): 800, ("small", "acta - zona"): 3, ("long", "acta - sur"): 3, ("letter", "fecha 19"): 3, ("hot", "fecha 19"): 15}
    on |= {("f1", "red | norte"): 1, ("f2", "red | norte"): 1} | {(f"other{i}", "acta - zona"): 12 for i in range(5)} | {(f"f{i}", "fecha 19"): 1 for i in range(40)}
    marks = [(f"{f}-{i}", f, None, a, None) for (f, a), k in on.items() for i in range(k)]
    m = spark.createDataFrame(marks, "chunk_id string, file_id string, kind string, anchor string, line string")
    n = spark.createDataFrame(list(sizes.items()), "file_id string, n long")
    got = {tuple(r) for r in scanned.header_anchors(m, n).collect()}
    assert got == {("hot", "red | norte"), ("small", "acta - zona"), ("long", "acta - sur")} | {(f"other{i}", "acta - zona") for i in range(5)}
    k = spark.createDataFrame([(3,), (20,), (21,), (100,), (5000,)], "k long")
    assert [r[0] for r in k.select(scanned._log_factorial(k.k)).collect()] == pytest.approx([math.lgamma(x + 1) for x in (3, 20, 21, 100, 5000)])


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6))
def test_leaks_with_evenly_spread_edits(seed):
    """Fifteen words with every fourth changed keep runs of three only; their
    fingerprints must meet whatever the hashes."""
    some = random.Random(seed)
    item = [f"w{some.randrange(10**9)}" for _ in range(40)]
    index = leakage.Index.build([(7, " ".join(item)), (8, "other words")])
    quoted = [f"x{i}" if i % 4 == 3 else w for i, w in enumerate(item[10:25])]
    found = index.leaks([f"y{i}" for i in range(some.randrange(30))] + quoted + ["end"])
    assert [x[0] for x in found] == [7]
    assert index.leaks([f"x{i}" if i % 3 == 2 else w for i, w in enumerate(item)]) == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_by_table_are_those_by_fold(text):
    assert leakage.words(text) == leakage._WORD.findall(text.translate(leakage._FOLD))


def test_personal_information(spark):
    known = [("NAME", "Ana Toro"), ("NAME", "Ana Lago"), ("NAME", "Luz Toro Lago"), ("NAME", "Luz Mora"), ("NAME", "Toro Mora, Luz"), ("NAME", "Mora Lago, Ana"), ("LOCATION", "Alto Mora"), ("NAME", None)]
    e = spark.createDataFrame([(str(i), *x) for i, x in enumerate(known)], "entity_id string, entity_type string, text string")
    texts = {
        "a": "Ana Toro vive en calle Ana Toro 55, RUT 12.378.895-8 y no 12.378.895-9.",
        "b": "doña LUZ MORA (+56) 9 1234 5678, mora.lago, Luz; toro mora, luz: ana.toro [at] mail.cl",
        "c": "ana\ntoro lago y Luz T. Mora, folio N° 912345678", "d": None, "e": "",
    }
    c = spark.createDataFrame([(k, t, TIME) for k, t in texts.items()], "chunk_id string, text string, updated_at timestamp")
    got = {(r.chunk_id, r.entity_type, r.start_pos) for r in personal.found_mentions(c, e).collect()}
    b = texts["b"]
    assert got == {
        ("a", "NAME", 0), ("a", "ADDRESS", 17), ("a", "RUT", texts["a"].index("12.")), ("b", "NAME", 5), ("b", "PHONE", b.index("(")),
        ("b", "NAME", b.index("toro mora")), ("b", "EMAIL", b.index("ana.toro")), ("c", "NAME", 0), ("c", "NAME", texts["c"].index("Luz")),
    }
    clean = {r.chunk_id: r.clean_text for r in personal.replaced(c, e, b"key").collect()}
    assert clean["d"] is None and clean["e"] == "" and "Toro" not in clean["a"] and "12.378.895-9" in clean["a"]
    assert clean["a"].startswith("[NAME ") and "[RUT " in clean["a"]


def test_surrogates_are_distinct_and_repeatable(spark):
    people = [("doña", "Carmen Toro Lago"), ("don", "Luca Mora"), ("", "Luca Mora Vera"), ("", "Toro, Carmen"), ("", "Ana T. Mora")]
    e = spark.createDataFrame([("NAME", "Carmen Toro"), ("NAME", "Luca Mora"), ("NAME", "Ana Vera"), ("NAME", "Ana Lago")] * 3, "entity_type string, text string")
    rows = [(str(i), f"Vino {title} {name} hoy, RUT 12.378.895-8, {'x' * 130}.y@correo.cl", TIME) for i, (title, name) in enumerate(people)]
    c = spark.createDataFrame(rows, "chunk_id string, text string, updated_at timestamp")
    clean = {r.chunk_id: r.clean_text for r in personal.replaced(c, e, b"k").collect()}
    assert clean == {r.chunk_id: r.clean_text for r in personal.replaced(c, e, b"k").collect()}
    names = {i: re.search(r"\[NAME ([^\]]*)\]", t).group(1).split() for i, t in clean.items()}
    # gender by title, the words a full and a shortened name share, inverted order, initials
    assert names["0"][0].endswith("na") and not names["1"][0].endswith("na")
    assert names["2"][:2] == names["1"] and names["3"] == [names["0"][1] + ",", names["0"][0]] and names["4"][1] != "T." and names["4"][2] == names["1"][1]
    assert all("xxxx" not in t for t in clean.values()) and len({re.search(r"\[RUT ([^\]]*)", t).group(1) for t in clean.values()}) == 1
    assert clean != {r.chunk_id: r.clean_text for r in personal.replaced(c, e, b"other").collect()}
    for r in personal.surrogate_faults(c, e, b"k").collect():
        assert r.values_seen == r.distinct_surrogates and r.real_values_hit == r.bad_format == 0
    with pytest.raises(ValueError):
        personal.replaced(c, e, b"")
    # none is like another, nor like a value that is really there
    hit = personal.surrogate("PHONE", "912345678", b"k")
    values = spark.createDataFrame([("PHONE", "912345678"), ("PHONE", hit)] + [("GIVEN", f"ana{i}") for i in range(50)], "entity_type string, value string")
    got = {r.value: r.surrogate for r in personal.assign_surrogates(values, b"k").collect()}
    assert len({s.lower() for s in got.values()}) == 52 and hit not in got.values()
    assert personal.dressed("RUT", "12.378.895-8", "501234567") == "50.123.456-7"


def test_long_and_odd_mentions():
    names = personal.Names({"ana"}, {"toro", "lago"})
    long = "l" * 150
    found = personal.find_mentions(f"{long}@correo.cl, Toro{' ' * 90}Lago,{' ' * 90}Ana", names)
    assert [k for k, _, _ in found] == ["EMAIL", "NAME"] and found[0][1:] == (0, 160)


def test_truncated_texts(spark):
    line = "El taller revisó las carpetas en la bodega de la oficina central."
    docs = [(i, line if i % 2 else f"{line} Saludos,\nLa oficina central", "A") for i in range(40)]
    docs += [(100, "El taller revisó las carpetas en la bod", "a"), (101, "Hoy el taller revisó las carpetas en…", "a"), (102, None, "a"), (103, "", "a"), (104, " \n", "a"), (105, line, None)]
    # distinct texts, or they count once
    docs = [(i, t and (f"Nota {i}. {t}" if i < 100 else t), s) for i, t, s in docs]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert {r.doc_id for r in truncation.cut_texts(d).collect()} == {100, 101}
    rates = {r.source: (r.documents, r.cut) for r in truncation.truncation_rates(d).collect()}
    assert rates == {"a": (42, 2), None: (1, 0)}
    assert truncation.cut_texts(d.limit(0)).count() == 0


def test_truncated_texts_long_last_lines(spark):
    """A last line of nine words that ends several texts is a usual ending; a
    cut line that the same words go on after elsewhere is none."""
    sign = "Oficina de partes del servicio de salud del norte"
    body = "El equipo de salud del norte grande revisó las fichas de la oficina de partes"
    docs = [(i, f"{body} número {i}.\n{sign}", "A") for i in range(4)]
    docs += [(10 + i, f"{body} número {i}.\n{body} en la semana {i}.", "A") for i in range(300)]
    docs += [(500 + i, f"Nota {i}.\n{body}", "b") for i in range(4)]
    docs += [(600, "Aviso｜fin.\n\n  El equipo de salud\u00a0del norte gran[…]", "b")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert {r.doc_id for r in truncation.cut_texts(d).collect()} == {500, 501, 502, 503, 600}


def test_oversized_chunks(spark):
    rows = [("a", "f", 1, 1, 2, "word " * 60, "ocr", TIME), ("b", "f", 2, 2, 2, "x" * 301, None, TIME), ("c", "f", 3, 3, 3, "y " * 40, "ocr", TIME), ("d", "f", 4, 9, 9, "z" * 900, None, TIME),
            ("a", "f", 1, 1, 2, "old " * 90, "ocr", None), ("e", "f", 5, 1, 1, None, "ocr", TIME)]
    pages = [("f", 2, "ocr", TIME)]
    limits = spark.createDataFrame([("ocr", 100, 20)], "method string, max_chars int, overlap_chars int")
    c, p = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(pages, PAGES)
    assert {r.chunk_id for r in split.oversized(c, p, limits).collect()} == {"a", "b"}
    pieces = split.resplit(c, p, limits).filter("text is not null").orderBy("chunk_index").collect()
    assert [r.chunk_index for r in pieces] == list(range(1, len(pieces) + 1))
    assert all(len(r.text) <= 100 for r in pieces if r.source_chunk_id in "ab") and pieces[0].page_start == 1
