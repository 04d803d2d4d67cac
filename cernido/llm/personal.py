"""Personal information inside free text: find it, put typed surrogates in its place.

Finding works on a folded copy of the text (lower case, no accents, no
look-alikes) of the same length, so every position is that of the text. Names
are given names with surnames; which words are which is learned from the
entities already known. Each value gets a keyed surrogate of its type, in the
gender, script and format of the original; the same value gets the same one
everywhere and different values get different ones.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cernido.llm.lookalike import CYRILLIC_LIKE, GREEK_LIKE, OTHER_LIKE
from cernido.tables import hashed, latest, written

MENTIONS = "array<struct<entity_type:string,start_pos:int,end_pos:int,value:string,gender:string>>"

_LIKE = CYRILLIC_LIKE | GREEK_LIKE | OTHER_LIKE
_INVISIBLE = re.compile("(?<=\\w)[\u200b-\u200d\u2060\ufeff\u00ad]+(?=[\\w@.])")


@lru_cache(maxsize=16384)
def _fold_char(c: str) -> str:
    d = unicodedata.normalize("NFKD", c)
    d = "".join(x for x in d if not unicodedata.combining(x)) or c
    if len(d) != 1:
        d = c
    d = _LIKE.get(d, d).lower()
    return d if len(d) == 1 else c


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        value = self[code] = _fold_char(chr(code))
        return value


_FOLD = _Fold()


_LATIN = bytes(ord(f) if ord(f := _fold_char(chr(i))) < 256 else i for i in range(256))


def fold(text: str) -> str:
    """The text in lower case without accents and look-alikes, of the same length."""
    if text.isascii():
        return text.lower()
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1")
    except UnicodeEncodeError:
        return text.translate(_FOLD)


# Street type words, and how an at sign and a dot are paraphrased.
_STREET = r"(?:avenida|avda\.?|av\.?|calle|pasaje|pasje\.?|psje\.?|pje\.?|camino|carretera|callejon|alameda|boulevard|diagonal)"
_AT = r"(?:@|\s?[\[({<]\s?(?:at|arroba)\s?[\])}>]\s?|\sarroba\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punto)\s?[\])}]\s?)"
_NOT_STREET = r"(?!(?:por|en|con|sin|desde|hasta|que|para|y|a|al|hace|fue|se|tel|fono|rut|run)\b)"

EMAIL = re.compile(rf"(?<![\w.+\-@])[a-z0-9][\w.+%\-]*{_AT}[a-z0-9][a-z0-9\-]*(?:{_DOT}[a-z0-9\-]*[a-z0-9])*{_DOT}[a-z]{{2,}}(?![\w@])")
RUT = re.compile(r"(?<![\w.,/\-])(?:\d{1,2}\.\d{3}\.\d{3}|\d{1,2}\s\d{3}\s\d{3}|\d{7,8})\s?[-‐‑–—]\s?[\dk](?![\w\-])")
PHONE = re.compile(
    r"(?<![\w.,/+\-])(?:(?:\(\s?\+?56\s?\)|\+\s?56|0056|56)[\s.\-]{0,2}[2-9](?:[\s.\-]?\d){8}|9(?:\s\d{4}\s\d{4}|\d{8}))(?![\w\-]|[.,]\d)"
)
ADDRESS = re.compile(
    rf"{_STREET}(?:\s+{_NOT_STREET}(?:\d{{1,3}}(?=\s+(?:norte|sur|oriente|poniente)\b)|[^\W\d_]+\.?)){{1,5}}\s*"
    r"(?:,?\s*(?:n[°o.]\s*|nro\.?\s*|numero\s+|km\s+|#\s*)|\s)(?<!\d)\d{1,5}(?:[.,]\d{1,3})?(?![\w°])"
)
#: what a mention can't do without, quick to search for
_AT_SIGN = re.compile(r"@|[\[({<]\s?(?:at|arroba)|arroba")
_DIGITS = re.compile(r"[\d(+][\d .+\-()\n]{6,}")
_STREET_HEAD = re.compile(r"(?:av(?:enida|da)?\b|calle|pas(?:aje|je)|p(?:s)?je|camino|carretera|callejon|alameda|boulevard|diagonal)")
_NUMBER_LABEL = re.compile(r"(?:n[°o]|folio|guia|codigo|factura)\s*\.?\s*$")
_GAP = r"(?:[ \t]*\n[ \t]*|[ \t]+)"
_AFTER = re.compile(rf"{_GAP}([^\W\d_]+)(\.?)")
_BEFORE = re.compile(rf"(?<![\w.@\-])(?:([^\W\d_]+){_GAP})?([^\W\d_]+)[ \t]*,{_GAP}$")


def right_check_digit(rut: str) -> bool:
    digits = re.sub(r"[^\dk]", "", rut)
    total = sum(int(d) * (2 + i % 6) for i, d in enumerate(reversed(digits[:-1])))
    return digits[-1] == "0123456789k0"[11 - total % 11]


@dataclass
class Names:
    """The words that are given names and those that are surnames, folded."""

    given: set[str]
    surnames: set[str]

    def __post_init__(self) -> None:
        self._given = re.compile(rf"(?<![^\W_])(?:{_trie(self.given)})(?![^\W_])") if self.given else None

    def find(self, bare: str) -> list[tuple[int, int]]:
        """Spans of a given name with surnames, in either order."""
        found: list[tuple[int, int]] = []
        if self._given is None:
            return found
        end = 0
        for m in self._given.finditer(bare):
            if m.start() < end or m.start() and bare[m.start() - 1] in "@_-":
                continue
            span = self._inverted(bare, m.start(), m.end(), end) or self._plain(bare, m.start(), m.end())
            if span:
                found.append(span)
                end = span[1]
        return found

    def _inverted(self, bare: str, start: int, stop: int, floor: int) -> tuple[int, int] | None:
        comma = bare.rfind(",", floor, start)
        if comma < 0 or not bare[comma + 1 : start].isspace():
            return None
        a = comma
        for kind in (str.isspace, str.isalpha, str.isspace, str.isalpha):  # back over up to two words
            while a > floor and kind(bare[a - 1]):
                a -= 1
        m = _BEFORE.search(bare, a, start)
        if not m or m.group(2) not in self.surnames or bare[stop : stop + 1] in ("@", "_"):
            return None
        first = m.group(1) in self.surnames if m.group(1) else False
        if not first and self._plain(bare, start, stop):
            return None
        nxt = _AFTER.match(bare, stop)
        if nxt and nxt.group(1) in self.given and not self._plain(bare, nxt.start(1), nxt.end(1)):
            stop = nxt.end(1)
        return (m.start(1) if first else m.start(2)), stop

    def _plain(self, bare: str, start: int, stop: int) -> tuple[int, int] | None:
        m = _AFTER.match(bare, stop)
        if m and (m.group(1) in self.given and not m.group(2) or len(m.group(1)) == 1 and m.group(2)):
            m = _AFTER.match(bare, m.end())
        if not m or m.group(1) not in self.surnames:
            return None
        stop = m.end(1)
        if not m.group(2):
            second = _AFTER.match(bare, stop)
            if second and second.group(1) in self.surnames and not self._starts_inverted(bare, second):
                stop = second.end(1)
        if bare[stop : stop + 1] in ("@", "_"):
            return None
        return start, stop

    def _starts_inverted(self, bare: str, first: re.Match) -> bool:
        second = _AFTER.match(bare, first.end(1))
        if not second or second.group(1) not in self.surnames:
            return False
        comma = re.match(rf"[ \t]*,{_GAP}([^\W\d_]+)", bare[second.end(1) : second.end(1) + 60])
        return bool(comma and comma.group(1) in self.given)


def _trie(words: set[str]) -> str:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        options = [re.escape(c) + pattern(child) for c, child in sorted(node.items()) if c]
        if not options:
            return ""
        body = options[0] if len(options) == 1 else f"(?:{'|'.join(options)})"
        return f"(?:{body})?" if "" in node else body

    return pattern(root)


def find_mentions(text: str, names: Names) -> list[tuple[str, int, int]]:
    """(entity_type, start, end) of all mentions, in order, none inside another.
    What lies in an e-mail or an address is part of it."""
    where = None
    if not text.isascii() and _INVISIBLE.search(text):
        where = [i for i in range(len(text))]
        cut = [m.span() for m in _INVISIBLE.finditer(text)]
        gone = {i for a, b in cut for i in range(a, b)}
        where = [i for i in where if i not in gone]
        bare = fold("".join(text[i] for i in where))
    else:
        bare = fold(text)
    found: list[tuple[str, int, int]] = []
    end = 0
    for at in _AT_SIGN.finditer(bare):
        a = at.start()
        if a > end and bare[a - 1].isspace():
            a -= 1
        while a > end and (bare[a - 1] in ".+%-" or bare[a - 1].isalnum() or bare[a - 1] == "_"):
            a -= 1
        while a < at.start() and not ("a" <= bare[a] <= "z" or "0" <= bare[a] <= "9"):
            a += 1
        m = EMAIL.match(bare, a) if end <= a < at.start() else None
        if m and m.end() > at.start():
            found.append(("EMAIL", *m.span()))
            end = m.end()
    for head in _STREET_HEAD.finditer(bare):
        a = head.start()
        if a and (bare[a - 1].isalnum() or bare[a - 1] in "._"):
            continue
        if (m := ADDRESS.match(bare, a)) and not any(s <= a < e for _, s, e in found):
            found.append(("ADDRESS", *m.span()))
    taken = [(a, b) for _, a, b in found]

    def free(a: int, b: int) -> bool:
        return all(b <= s or e <= a for s, e in taken)

    for digits in _DIGITS.finditer(bare):
        a, b = digits.start(), min(len(bare), digits.end() + 6)
        for m in RUT.finditer(bare, a, b):
            if right_check_digit(m.group()) and free(*m.span()):
                found.append(("RUT", *m.span()))
                taken.append(m.span())
        for m in PHONE.finditer(bare, a, b):
            if free(*m.span()) and not (m.group()[0] == "9" and _NUMBER_LABEL.search(bare, max(0, m.start() - 12), m.start())):
                found.append(("PHONE", *m.span()))
                taken.append(m.span())
    found += [("NAME", a, b) for a, b in names.find(bare) if free(a, b)]
    found.sort(key=lambda x: x[1])
    if where is not None:
        found = [(kind, where[a], where[b - 1] + 1) for kind, a, b in found]
    return found


def canonical_value(kind: str, mention: str) -> str:
    """What all mentions of one person, number or place have in common."""
    bare = fold(_INVISIBLE.sub("", mention))
    if kind == "NAME":
        if "," in bare:
            last, first = bare.split(",", 1)
            bare = f"{first} {last}"
        return " ".join(bare.split())
    if kind == "RUT":
        return re.sub(r"[^\dk]", "", bare)
    if kind == "PHONE":
        return re.sub(r"\D", "", bare)[-9:]
    if kind == "EMAIL":
        return re.sub(_DOT, ".", re.sub(_AT, "@", bare))
    return " ".join(re.sub(r"[.,#°]", " ", bare).split())


# ---- learning the names -------------------------------------------------------------

#: a name word makes up at least this share of all name words, which bounds their number by half a million
NAME_SHARE = 2e-6
_NAME_SHAPE = re.compile(r"[^\W\d_]+(?: [^\W\d_]+| [^\W\d_]\.)?(?: [^\W\d_]+){1,2}|[^\W\d_]+(?: [^\W\d_]+)?, [^\W\d_]+")


def count_name_words(entities: DataFrame) -> DataFrame:
    """(word, given, surname, other): in which places of known entities a folded
    word stands. Counted within the tasks before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given, surname, other = Counter(), Counter(), Counter()
        for batch in batches:
            for kind, text in zip(batch["entity_type"], batch["text"], strict=True):
                bare = " ".join(fold(_INVISIBLE.sub("", text)).split())
                if kind == "NAME" and _NAME_SHAPE.fullmatch(bare):
                    if "," in bare:
                        last, first = bare.split(", ", 1)
                        given.update(first.split())
                        surname.update(last.split())
                    else:
                        words = bare.split()
                        given[words[0]] += 1
                        surname[words[-1]] += 1
                else:
                    other.update(re.findall(r"[^\W\d_]+", bare))
        rows = [(w, given[w], surname[w], other[w]) for w in {*given, *surname}]
        rows += [(w, 0, 0, n) for w, n in other.items() if w not in given and w not in surname]
        yield pd.DataFrame(rows, columns=["word", "given", "surname", "other"])

    kinds = ["NAME", "LOCATION", "HEALTH_SYSTEM", "MARITAL_STATUS", "MEDICAL_PROBLEM"]
    rows = entities.filter(F.col("text").isNotNull() & F.col("entity_type").isin(kinds)).select("entity_type", "text")
    return (
        rows.mapInPandas(count, "word string, given long, surname long, other long")
        .groupBy("word")
        .agg(*[F.sum(c).alias(c) for c in ("given", "surname", "other")])
    )


def learn_names(entities: DataFrame) -> Names:
    """Given names and surnames from all known entities. A word must stand in
    names more often than elsewhere, and in one place three times as often as
    in the other. The share bounds what the driver takes."""
    counts = written(count_name_words(entities), "names")
    total = counts.agg(F.sum(F.col("given") + F.col("surname"))).first()[0] or 0
    kept = counts.filter(
        (F.col("given") + F.col("surname") >= max(2, total * NAME_SHARE))
        & (F.col("given") + F.col("surname") > F.col("other"))
        & (F.length("word") > 2)
    )
    given, surnames = set(), set()
    for word, as_given, as_surname, _ in kept.toLocalIterator():
        if as_given > 3 * as_surname:
            given.add(word)
        elif as_surname > 3 * as_given:
            surnames.add(word)
    return Names(given, surnames)


def mentions(chunks: DataFrame, names: Names) -> DataFrame:
    """(chunk_id, mentions) of the latest rows; a null text has none."""
    shared = chunks.sparkSession.sparkContext.broadcast(names)
    rows = latest(hashed(chunks.select("chunk_id", "text", "updated_at"), "chunk_id"), ["chunk_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = find_mentions(text, known) if text else []
                out.append([
                    {"entity_type": k, "start_pos": a, "end_pos": b, "value": canonical_value(k, text[a:b]), "gender": title_gender(text, a) if k == "NAME" else None}
                    for k, a, b in found
                ])
            yield pd.DataFrame({"chunk_id": batch["chunk_id"], "mentions": out})

    return rows.select("chunk_id", "text").mapInPandas(run, f"chunk_id string, mentions {MENTIONS}")


def found_mentions(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """(chunk_id, entity_type, start_pos), one row per mention. Empty tables give none."""
    found = mentions(chunks, learn_names(entities))
    return found.select("chunk_id", F.inline("mentions")).select("chunk_id", "entity_type", "start_pos").distinct()


# ---- surrogates ---------------------------------------------------------------------

# Titles before a name, and the syllables that surrogate names and streets are made of.
_TITLE = re.compile(r"(?:(don|sr|senor|mr)|(dona|sra|srta|senora|senorita|mrs|ms))\.?\s+$")
_HEADS = ["Bra", "Cle", "Dori", "Fau", "Gre", "Hila", "Jude", "Kari", "Leo", "Mila", "Nora", "Ola", "Pala", "Rosi", "Sila", "Tere"]
_MIDDLES = ["be", "da", "fi", "go", "la", "me", "ni", "ra", "so", "ta", "vi", "xe", "lu", "ro", "mi", "po"]
_CYRILLIC_HEADS = ["Бра", "Вале", "Гори", "Дани", "Зори", "Ками", "Лари", "Мила"]
_CYRILLIC_MIDDLES = ["бе", "да", "фи", "го", "ла", "ме", "ни", "ра"]
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def title_gender(text: str, start: int) -> str | None:
    """``m`` or ``f`` where the title before a name tells it."""
    m = _TITLE.search(fold(text[max(0, start - 16) : start]))
    return None if m is None else "m" if m.group(1) else "f"


class _Draw:
    """Numbers drawn from a keyed hash of a value."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        seed = hashlib.blake2b(f"{kind}\x00{value}\x00{attempt}".encode(), key=key[:64], digest_size=64).digest()
        self._left = int.from_bytes(seed, "big")

    def below(self, n: int) -> int:
        self._left, value = divmod(self._left, n)
        return value


def _word(draw: _Draw, cyrillic: bool, ending: str) -> str:
    heads, middles = (_CYRILLIC_HEADS, _CYRILLIC_MIDDLES) if cyrillic else (_HEADS, _MIDDLES)
    parts = [heads[draw.below(len(heads))], *[middles[draw.below(len(middles))] for _ in range(3)]]
    return "".join(parts) + ending


def _initial(letter: str, key: bytes) -> str:
    """Another letter for an initial, each letter its own."""
    order = sorted(_LETTERS, key=lambda c: hashlib.blake2b(c.encode(), key=key[:64]).digest())
    return order[(order.index(letter) + 1) % len(order)].upper() if letter in order else letter.upper()


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0, gender: str | None = None) -> str:
    """The plain surrogate of a canonical value, before its mention's format. Names
    have one for each word, so a person's full and shortened name keep the
    words they share. The gender of a given name that no title tells is guessed
    by its ending."""
    draw = _Draw(key, kind, value, attempt)
    if kind in ("GIVEN", "SURNAME"):
        cyrillic = "а" <= value[0] <= "я"
        if kind == "SURNAME":
            return _word(draw, cyrillic, "в" if cyrillic else "z")
        female = gender == "f" if gender else value[-1] in "aая"
        return _word(draw, cyrillic, ("на" if cyrillic else "na") if female else ("н" if cyrillic else "n"))
    if kind == "INITIAL":
        return _initial(value[0], key) + value[1:]
    if kind == "RUT":
        body = str(50_000_000 + draw.below(49_999_999)) if len(value) > 8 else str(5_000_000 + draw.below(4_999_999))
        total = sum(int(d) * (2 + i % 6) for i, d in enumerate(reversed(body)))
        return body + "0123456789K0"[11 - total % 11]
    if kind == "PHONE":
        return value[0] + f"{draw.below(10**8):08d}"
    if kind == "EMAIL":
        return f"{_word(draw, False, '').lower()}{draw.below(10**6)}@{_word(draw, False, '').lower()}.invalid"
    words = value.split()
    return f"{words[0]} {_word(draw, False, '')} {1 + draw.below(9999)}"


def dressed(kind: str, mention: str, plain: str) -> str:
    """The surrogate in the format of its mention: order, case, separators."""
    if kind == "NAME" and "," in mention:
        words = plain.split()
        n = max(1, len(mention.split(",")[0].split()))
        plain = f"{' '.join(words[-n:])}, {' '.join(words[:-n])}"
    if kind in ("RUT", "PHONE"):
        digits = re.sub(r"[^\dkK]", "", fold(mention))
        fill = iter((digits[: len(digits) - len(plain)] + plain).upper())
        plain = "".join(next(fill, "") if c.isdigit() or c in "kK" else c for c in fold(mention))
    letters = [c for c in mention if c.isalpha()]
    if kind in ("NAME", "ADDRESS", "EMAIL") and letters:
        if all(c == c.upper() for c in letters):
            return plain.upper()
        if all(c == c.lower() for c in letters):
            return plain.lower()
    return plain


def assign_surrogates(values: DataFrame, key: bytes, max_rounds: int = 20) -> DataFrame:
    """(entity_type, value, surrogate) of distinct values, no two of a type alike,
    and none alike to a value that is really there.

    ``values`` may have a ``gender``. Values that draw the same surrogate are
    ranked; the first keeps it, the others draw again with a counter, as those
    do that hit a real value. Each round shuffles only who has none yet.
    """

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series, gender: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, v, key, int(a), g or None) for k, v, a, g in zip(kind, value, attempt, gender, strict=True)])

    gender = F.max("gender") if "gender" in values.columns else F.lit(None).cast("string")
    real = written(values.groupBy("entity_type", "value").agg(gender.alias("gender")), "values")
    todo = real.withColumn("attempt", F.lit(0))
    done = None
    for _ in range(max_rounds):
        cast = written(todo.withColumn("surrogate", drawn("entity_type", "value", "attempt", F.coalesce("gender", F.lit("")))), "cast")
        low = cast.withColumn("low", F.lower("surrogate"))
        same = Window.partitionBy("entity_type", "low").orderBy("value")
        first = low.withColumn("rank", F.row_number().over(same)).filter("rank = 1 or entity_type = 'INITIAL'")
        taken = real.filter("entity_type <> 'INITIAL'").select("entity_type", F.col("value").alias("low"))
        if done is not None:
            taken = taken.unionByName(done.select("entity_type", F.lower("surrogate").alias("low")))
        first = written(first.join(taken, ["entity_type", "low"], "left_anti").select("entity_type", "value", "surrogate"), "first")
        done = first if done is None else done.unionByName(first)
        todo = cast.join(first.select("entity_type", "value"), ["entity_type", "value"], "left_anti")
        todo = written(todo.select("entity_type", "value", "gender", (F.col("attempt") + 1).alias("attempt")), "again")
        if todo.isEmpty():
            return done
    raise RuntimeError("surrogates keep colliding; use a larger alphabet")


def surrogates_of(each: DataFrame, key: bytes) -> DataFrame:
    """(entity_type, value, surrogate) of the values of mentions. A name's is made of
    its words', whose gender is that of most titles before the given name."""
    names = each.filter("entity_type = 'NAME'").groupBy("value").agg(
        F.count_if(F.col("gender") == "f").alias("f"), F.count_if(F.col("gender") == "m").alias("m")
    )
    # given names come first, of four words or more they are two
    kind = F.when(F.length(F.rtrim("word", F.lit("."))) == 1, "INITIAL").when((F.col("n") == 0) | (F.col("n") == 1) & (F.col("size") > 3), "GIVEN").otherwise("SURNAME")
    words = F.split("value", " ")
    parts = names.select("value", "f", "m", F.size(words).alias("size"), F.posexplode(words).alias("n", "word")).withColumn("kind", kind)
    parts = written(parts.drop("size"), "name_words")
    told = parts.groupBy("kind", "word").agg(F.sum("f").alias("f"), F.sum("m").alias("m"))
    told = told.select(
        F.col("kind").alias("entity_type"), F.col("word").alias("value"), F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").alias("gender")
    )
    other = each.filter("entity_type <> 'NAME'").select("entity_type", "value", F.lit(None).cast("string").alias("gender"))
    plain = assign_surrogates(told.unionByName(other), key)
    of_word = plain.select(F.col("entity_type").alias("kind"), F.col("value").alias("word"), "surrogate")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "surrogate"))), lambda x: x["surrogate"]), " ")
    full = parts.join(of_word, ["kind", "word"]).groupBy("value").agg(whole.alias("surrogate"))
    return plain.filter(~F.col("entity_type").isin("GIVEN", "SURNAME", "INITIAL")).unionByName(full.select(F.lit("NAME").alias("entity_type"), "value", "surrogate"))


def replaced(chunks: DataFrame, entities: DataFrame, key: bytes) -> DataFrame:
    """(chunk_id, clean_text): the latest texts with ``[TYPE surrogate]`` for each
    mention. A null text stays null, a text without mentions stays as it is.
    ``key`` is a secret: with it, and only with it, the same surrogates come again."""
    if not key:
        raise ValueError("surrogates need a secret key")
    found = written(mentions(chunks, learn_names(entities)), "mentions")
    each = found.select("chunk_id", F.inline("mentions"))
    named = each.join(surrogates_of(each, key), ["entity_type", "value"])
    cover = named.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("start_pos", "end_pos", "entity_type", "surrogate"))).alias("cover"))

    @F.pandas_udf("string")
    def put(text: pd.Series, cover: pd.Series) -> pd.Series:
        return pd.Series([_put(t, c) for t, c in zip(text, cover, strict=True)])

    rows = latest(chunks.select("chunk_id", "text", "updated_at"), ["chunk_id"]).drop("updated_at")
    return rows.join(cover, "chunk_id", "left").select("chunk_id", put("text", "cover").alias("clean_text"))


def surrogate_faults(chunks: DataFrame, entities: DataFrame, key: bytes) -> DataFrame:
    """(entity_type, values_seen, distinct_surrogates, real_values_hit, bad_format): how far
    the surrogates of a corpus keep distinctness, avoid real values and have
    the form of their type. All but the first two counts should be zero, and
    these two equal."""
    each = written(mentions(chunks, learn_names(entities)), "mentions").select(F.inline("mentions"))
    given = written(surrogates_of(each, key), "surrogates")
    low = given.withColumn("low", F.lower("surrogate"))
    hit = low.join(given.select("entity_type", F.col("value").alias("low")), ["entity_type", "low"], "left_semi").groupBy("entity_type").agg(F.count("*").alias("hit"))
    form = (
        F.when(F.col("entity_type") == "RUT", r"^\d{7,8}[\dK]$").when(F.col("entity_type") == "PHONE", r"^[2-9]\d{8}$")
        .when(F.col("entity_type") == "EMAIL", r"^[a-z0-9]+@[a-z]+\.invalid$").otherwise(r"^\S+( \S+)+$")
    )
    sums = low.groupBy("entity_type").agg(
        F.count_distinct("value").alias("values_seen"), F.count_distinct("low").alias("distinct_surrogates"), F.count_if(~F.regexp_like("surrogate", form)).alias("bad_format")
    )
    return sums.join(hit, "entity_type", "left").select("entity_type", "values_seen", "distinct_surrogates", F.coalesce("hit", F.lit(0)).alias("real_values_hit"), "bad_format")


def _put(text: str | None, cover) -> str | None:
    if text is None or cover is None:
        return text
    parts, at = [], 0
    for m in cover:
        a, b = m["start_pos"], m["end_pos"]
        parts += [text[at:a], f"[{m['entity_type']} {dressed(m['entity_type'], text[a:b], m['surrogate'])}]"]
        at = b
    return "".join([*parts, text[at:]])
