"""One form for text that looks the same but differs in its characters.

Only unstable segments are touched: runs of characters that fail the
normalization quick check (or are invisible, or look like another letter),
with the character before them as context. The canonical segment is spliced
into the unchanged rest.
"""

from __future__ import annotations

import glob
import os
import re
import struct
import unicodedata
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyspark
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cernido.tables import latest, written

# Letters of other scripts that look like a Latin one.
CYRILLIC_LIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
}
GREEK_LIKE = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "α": "a", "ρ": "p", "ϲ": "c", "ϳ": "j",
}
OTHER_LIKE = {"ɑ": "a", "ɡ": "g", "օ": "o", "‐": "-", "‑": "-", "º": "°", "˗": "-"}
#: compatibility forms that a reader sees as different (superscripts, fractions ...)
VISIBLE_FORMS = {"<super>", "<sub>", "<fraction>", "<circle>", "<square>"}


def confusable_letters() -> dict[str, str]:
    """Letters and digits that look like one of another script, by Unicode's
    published table of confusables in the ICU library that Spark ships with.

    Characters of one prototype and one category (capital, small, digit) form a
    class; its Latin letter, else its first character, stands for it. Letters
    that only look alike in other case or as digits stay apart.
    """
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    for folder in (home, os.path.dirname(pyspark.__file__)):
        for jar in glob.glob(f"{folder}/jars/icu4j-*.jar"):
            with zipfile.ZipFile(jar) as z:
                data = z.read("com/ibm/icu/impl/data/icudata/confusables.cfu")
            data = data[struct.unpack_from(">H", data)[0] :]
            at_keys, n_keys, at_values, n_values, at_text = struct.unpack_from(">5i", data, 12)
            values = struct.unpack_from(f">{n_values}H", data, at_values)
            alike: dict[tuple[str, str], list[str]] = {}
            for key, value in zip(struct.unpack_from(f">{n_keys}i", data, at_keys), values, strict=True):
                c = chr(key & 0xFFFFFF)
                if key >> 24 == 0 and unicodedata.category(c) in ("Lu", "Ll", "Nd") and unicodedata.normalize("NFKC", c) == c:
                    alike.setdefault((chr(value), unicodedata.category(c)), []).append(c)
            for c in map(chr, range(0x30, 0x7B)):
                if c.isalnum():
                    alike.setdefault((c, unicodedata.category(c)), []).append(c)
            return {c: min(members) for members in alike.values() for c in members if c != min(members) and not c.isascii()}
    return {}


def _fixed() -> dict[str, str]:
    return CYRILLIC_LIKE | GREEK_LIKE | OTHER_LIKE


class Looks:
    """A table of look-alikes with the quick check for it."""

    def __init__(self, table: dict[str, str]):
        self.table = table
        self.letters = str.maketrans(table)
        self.unstable = _quick_check(table)


@lru_cache(maxsize=4)
def _looks_of(items: tuple[tuple[str, str], ...]) -> Looks:
    return Looks(dict(items))


@lru_cache(maxsize=1)
def known_looks() -> Looks:
    """All look-alikes: the public table, the fixed values before it."""
    return _looks_of(tuple(sorted((confusable_letters() | _fixed()).items())))


_TO_CYRILLIC = str.maketrans({v: k for k, v in CYRILLIC_LIKE.items()})
_CYRILLIC_ONLY = re.compile("[{}]".format("".join(c for c in map(chr, range(0x400, 0x530)) if c not in CYRILLIC_LIKE)))
_LATIN_ONLY = re.compile("[{}]".format("".join(c for c in "".join(map(chr, range(0x41, 0x250))) if c.isalpha() and c not in CYRILLIC_LIKE.values())))
_WORD = re.compile(r"\w+")
#: planes with assigned characters: 0 to 3, and the tags of plane 14
_ASSIGNED = [*range(0x33480), *range(0xE0000, 0xE0200)]


@lru_cache(maxsize=4096)
def _fold(c: str) -> str:
    """One character in its plain form: nothing if invisible, a space if blank."""
    if unicodedata.category(c) == "Cf" or c in "︎️͏":
        return ""
    if unicodedata.category(c) == "Zs":
        return " "
    kind = unicodedata.decomposition(c).split(" ")
    if kind[0] in VISIBLE_FORMS or kind[:2] == ["<compat>", "0020"]:
        return c
    return unicodedata.normalize("NFKC", c)


def _quick_check(table: dict[str, str]) -> re.Pattern:
    """The quick check: characters whose segment may change, with one before."""
    second = set()
    for i in _ASSIGNED:
        parts = unicodedata.decomposition(chr(i)).split(" ")
        if len(parts) == 2 and parts[0][0] != "<":
            second.add(int(parts[1], 16))
    ranges: list[list[int]] = []
    for i in _ASSIGNED:
        c = chr(i)
        if i >= 0x80 and not (0xD800 <= i < 0xE000) and (unicodedata.combining(c) or i in second or 0x1160 <= i < 0x1200 or c in table or _fold(c) != c):
            if ranges and ranges[-1][1] == i - 1:
                ranges[-1][1] = i
            else:
                ranges.append([i, i])
    inside = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" if b > a else re.escape(chr(a)) for a, b in ranges)
    return re.compile(f"[^{inside}]?[{inside}]+", re.S)


def _plain(segment: str) -> str:
    return unicodedata.normalize("NFC", "".join(map(_fold, unicodedata.normalize("NFC", segment))))


def _one_script(word: str, looks: Looks) -> str:
    if word.isascii():
        return word
    if _CYRILLIC_ONLY.search(word) and not _LATIN_ONLY.search(word):
        return word.translate(_TO_CYRILLIC)
    if not _ASCII_LETTER.search(word) and any(c.isalpha() and c not in looks.table for c in word):
        return word  # a genuine word of another script
    return word.translate(looks.letters)


_ASCII_LETTER = re.compile("[A-Za-z]")


def skeleton(text: str | None, looks: Looks | None = None) -> str | None:
    """What a reader sees, for comparisons: every look-alike in the form of its
    class. Letter case and accents stay."""
    if text is None:
        return None
    if text.isascii():
        return text.strip()
    looks = looks or known_looks()

    def look(m: re.Match) -> str:
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", _plain(m.group())).translate(looks.letters))

    return looks.unstable.sub(look, text).strip()


def canonical(text: str | None, looks: Looks | None = None) -> str | None:
    """The one form of a text: words of mixed scripts are brought to the script
    of their other letters, genuine words of one script stay. Null stays null."""
    if text is None:
        return None
    if text.isascii():
        return text.strip()
    looks = looks or known_looks()
    plain = looks.unstable.sub(lambda m: _plain(m.group()), text)
    return _WORD.sub(lambda m: _one_script(m.group(), looks), plain).strip()


def _series(f: Callable[[str, Looks], str]) -> Column:
    """The driver's table goes with the function, so all workers have the same."""
    items = tuple(sorted(known_looks().table.items()))

    @F.pandas_udf("string")
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        looks = _looks_of(items)
        for part in parts:
            yield part.map(lambda text: f(text, looks), na_action="ignore")

    return apply


def skeleton_col(c: Column | str) -> Column:
    return _series(skeleton)(c)


def canonical_col(c: Column | str) -> Column:
    return _series(canonical)(c)


def canonical_entities(entities: DataFrame) -> DataFrame:
    """(file_id, entity_id, entity_type, text, canonical_text, canonical_key) of the latest rows.
    The key is the canonical text in lower case. Null texts have null forms."""
    rows = latest(entities.select("file_id", "entity_id", "entity_type", "text", "updated_at"), ["file_id", "entity_id"])
    return rows.drop("updated_at").withColumn("canonical_text", canonical_col("text")).withColumn("canonical_key", F.lower("canonical_text"))


#: what str.strip takes off an ASCII text
_ASCII_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def same_look_pairs(entities: DataFrame) -> DataFrame:
    """(file_id, entity_id_a, entity_id_b): entities of one file and type whose
    texts look the same but are different strings, smaller id first.

    Texts are brought to what a reader sees once, ASCII ones within the JVM, and
    written. Groups that hold one string only, as most do, are found by a
    minimum and a maximum combined before the shuffle and go no further; of the
    others the distinct strings are paired and only those pairs expanded to
    entities, so thousands of equal strings never meet each other. Groups are
    told apart by 128 bits of hash, strings within one by 64. Null texts and
    types match nothing; an empty table gives no rows.
    """
    rows = latest(entities.select("file_id", "entity_id", "entity_type", "text", "updated_at"), ["file_id", "entity_id"])
    rows = rows.filter("text is not null and entity_type is not null and file_id is not null")
    is_ascii = F.octet_length("text") == F.length("text")
    plain = rows.filter(is_ascii).withColumn("look", F.btrim("text", F.lit(_ASCII_BLANKS)))
    other = rows.filter(~is_ascii).withColumn("look", skeleton_col("text"))
    key = ["look_1", "look_2"]
    looked = written(
        plain.unionByName(other).select(
            "file_id", "entity_id", F.xxhash64("file_id", "entity_type", "look").alias("look_1"), F.xxhash64("look", "entity_type", "file_id").alias("look_2"),
            F.xxhash64("text").alias("string"),
        ), "looks",
    )
    varied = looked.groupBy(*key).agg(F.min("string").alias("lo"), F.max("string").alias("hi")).filter("lo <> hi").select(*key)
    some = written(looked.join(varied, key), "varied")
    strings = some.select(*key, "string").distinct()
    a = strings.withColumnRenamed("string", "string_a")
    pairs = a.join(strings.withColumnRenamed("string", "string_b"), key).filter("string_a < string_b")
    left = some.select(*key, F.col("string").alias("string_a"), "file_id", F.col("entity_id").alias("one"))
    right = some.select(*key, F.col("string").alias("string_b"), F.col("entity_id").alias("two"))
    both = left.join(pairs, [*key, "string_a"]).join(right, [*key, "string_b"])
    return both.filter("one <> two").select("file_id", F.least("one", "two").alias("entity_id_a"), F.greatest("one", "two").alias("entity_id_b")).distinct()
