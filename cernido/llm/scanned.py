"""Noise in text from scanned pages: find it and repair the text.

Misrecognised words are decoded as a noisy channel: the likelihood of a word in
its place, from word pairs of the corpus' own unscanned text, times the
probability of the character confusions that lead to what was read. Viterbi
picks the best words of a line. Words divided at a line end, page numbers and
the running header of a file are found first and taken out of the way.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cernido.tables import bounded_broadcast, hashed, latest, scratch_path, spread, written

SCANNED = ["ocr", "both"]

# What is read -> what stands there, the usual confusions of recognition.
CONFUSIONS = {
    "0": ["o"], "1": ["l", "i"], "5": ["s"], "6": ["b"], "8": ["b"], "9": ["g"],
    "c": ["e"], "e": ["c"], "l": ["i"], "i": ["l"], "u": ["n"], "n": ["u", "ri"], "q": ["g"], "b": ["h"], "h": ["b"],
    "rn": ["m"], "m": ["rn"], "fi": ["ti"], "f": ["t"], "vv": ["w"], "cl": ["d"], "d": ["cl"], "ii": ["u"], "ri": ["n"],
    "s": ["5"], "g": ["q"], "t": ["f"],
}
#: log probability of one confusion before any is estimated
CONFUSED = math.log(0.002)
#: a word or word pair of the model makes up at least this share of the corpus,
#: which bounds the model by a million words and half a million pairs
WORD_SHARE, PAIR_SHARE = 1e-6, 2e-6
#: at most so many confusions in a word, and one for every four letters of a longer one
MOST_EDITS = 3
#: shorter words are only misread where they stand free of codes
LEAST_LENGTH = 4

_HYPHEN = "-‐‑–¬­"
_LETTER = r"[^\W\d_]"
_DIVIDED_ANY = re.compile(rf"[{_HYPHEN}](?:[ \t]*\n\s*|[ \t]+)(?={_LETTER})")
_DIVIDED_FLAT = re.compile(rf"[{_HYPHEN}]\s+(?={_LETTER})|­(?={_LETTER})")
_ENDING = re.compile(rf"{_LETTER}+\Z")
_BEGINNING = re.compile(rf"{_LETTER}+")
_DIVISION = re.compile(rf"[{_HYPHEN}](?:\s+|(?<=­))(?={_LETTER})")
_COUNTED = re.compile(rf"(?<!\w){_LETTER}+(?:-{_LETTER}+)*(?!\w)")
_TOKEN = re.compile(r"[^\W_]+")
_TOKENS = re.compile(r"([^\W_]+)")
_ADDRESS_SIGN = re.compile(r"@|＠|://|\[at\]|\(arroba\)")
_BLANK = re.compile(r"\s|\Z")
#: short words with a digit that may be misread stand free and are no ordinals
_BEFORE_FREE = re.compile(r"[\s(\[«\"'“¿¡]")
_AFTER_FREE = re.compile(r"[.,;:)\]»\"'”?!]*\s")
_ORDINAL = re.compile(r"\d(?:er|[rdtmvn][oa]|st|nd|rd|th)\Z")

_NUMBERED = r"(?:p[áa][gq](?:[il1]na|\.)?|hoja|page)\s*\d{1,4}(?:\s*(?:de|/|of)\s*\d{1,4})?"
_DASHED = r"[—–·•-]\s*\d{1,4}\s*[—–·•-]|\[\d{1,4}\]|\d{1,4}\s*/\s*\d{1,4}"
_PAGE_LINE = re.compile(rf"^[ \t]*(?:{_NUMBERED}|{_DASHED})[ \t]*$", re.M | re.I)
_PAGE_FLAT = re.compile(
    rf"(?<!\S)(?:(?:p[áa][gq](?:[il1]na|\.)|hoja|page)\s\d{{1,4}}(?:\s?(?:de|/|of)\s?\d{{1,4}})?(?![\w/])"
    r"|[—–·•-] \d{1,4} [—–·•-](?!\S)|\[\d{1,4}\](?!\S)|\d{1,4} / \d{1,4}(?!\S))",
    re.I,
)
#: a reference to a page belongs to its sentence
_REFERS = re.compile(r"(?:\b(?:la|las|una|the|see|véase|ver)\s+)$", re.I)
_GOES_ON = re.compile(r"\s+(?:del|de la|of the)\b", re.I)

_SIGN = re.compile(r"[|·—–/•]")
_WORD_AFTER = re.compile(r"[ \t]+(\w+)")
_NUMBER = re.compile(r"\d[\d/-]*(?=\s|\Z)")


@lru_cache(maxsize=8192)
def _bare(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", c.lower()) if not unicodedata.combining(x))[:1] or c


class _Fold(dict):
    """Lower case without accents, one character for one."""

    def __missing__(self, code: int) -> str:
        value = self[code] = _bare(chr(code))
        return value


_FOLD = _Fold()


def _word_start(text: str, end: int) -> int:
    """Where the run of letters that ends there begins."""
    while end and text[end - 1].isalpha():
        end -= 1
    return end


def _without_divided(text: str) -> str:
    """The text with a blank for each divided word, both parts and all, found by the
    division, as few words have one."""
    parts, at = [], 0
    for m in _DIVISION.finditer(text):
        start = m.start()
        while start > at and text[start - 1].isalnum() and not text[start - 1].isdecimal():
            start -= 1
        if start < m.start():
            parts += [text[at:start], " "]
            at = _BEGINNING.match(text, m.end()).end()
    return "".join([*parts, text[at:]]) if parts else text


def _blank_start(text: str, end: int) -> int:
    """Where the blanks that end there begin."""
    while end and text[end - 1] in " \t":
        end -= 1
    return end


def _word_before(text: str, end: int, more: str = "") -> str:
    """The word of letters, digits, _ and ``more`` that ends there. Only its own
    characters are read, however long the run that it ends."""
    start = end
    while start and ((c := text[start - 1]).isalnum() or c == "_" or c in more):
        start -= 1
    return text[start:end]


def _before_sign(text: str, at: int) -> str:
    """The word that blanks divide from the sign there; empty without one."""
    end = _blank_start(text, at)
    return _word_before(text, end, ".") if end < at else ""


def _label_before(text: str, at: int) -> str:
    """The word that blanks, or blanks and a number sign, divide from the number
    there; empty without one."""
    end = _blank_start(text, at)
    if end > 1 and text[end - 1] in "°º" and text[end - 2] in "nN":
        before = _blank_start(text, end - 2)
        if before < end - 2 and (word := _word_before(text, before)):
            return word
    return _word_before(text, end) if end < at else ""


def is_flat(text: str) -> bool:
    return "\n" not in text


def page_numbers(text: str) -> list[tuple[int, int]]:
    """Spans of page numbers that stand apart from the sentences, with their line
    end. A line that holds a number only is one where the lines around it aren't
    those of a column, a telephone or a street number: see ``_stands_apart``."""
    found = []
    flat = is_flat(text)
    for m in (_PAGE_FLAT if flat else _PAGE_LINE).finditer(text):
        if _REFERS.search(text[max(0, m.start() - 12) : m.start()]) and _GOES_ON.match(text, m.end()):
            continue
        found.append(m.span())
    if not flat:
        found += [m.span() for m in _BARE_LINE.finditer(text) if _stands_apart(text, *m.span())]
        found = [(a, b + 1 if b < len(text) else b) for a, b in sorted(found)]
    return found


_BARE_LINE = re.compile(r"^[ \t]*\d{1,3}[ \t]*$", re.M)
_SENTENCE_END = re.compile(r"(?:[^\W\d_]{3,}|\d|[)\"»”])[.?!…]+[)\"»”]?\Z")
#: fixed values: words that a number belongs to
_NUMBER_FOLLOWS = re.compile(r"\b(?:tel[ée]?f?|fono|dep(?:ar)?to|dpto|block|blk|casa|of|oficina|piso|sala|km|n[°ºo]|nro|num|bodega|m[óo]dulo|folio|casilla|lote|al|a)\.?\Z", re.I)


def _stands_apart(text: str, a: int, b: int) -> bool:
    """Whether a number alone on its line belongs to none of its neighbours: it
    begins or ends the text, or follows a sentence, a heading or a divided word,
    or interrupts a sentence between two words. Numbers above or below it, and
    lines before it that end in a number or in a word that takes one, speak
    against."""
    c = text.rfind("\n", 0, max(0, a - 1)) + 1
    before = text[c : max(0, a - 1)].rstrip() if a else None
    d = text.find("\n", b + 1)
    after = text[b + 1 : len(text) if d < 0 else d].lstrip() if b < len(text) else None
    if after and after[0].isdigit() or before and _NUMBER_FOLLOWS.search(before):
        return False
    if not before:
        return before is None or not after or not after[0].islower()
    if _SENTENCE_END.search(before):
        return not before.rstrip(".").isdigit()
    if before[-1] in _HYPHEN:
        return bool(after) and after[0].isalpha()
    return bool(after) and before[-1].isalpha() and (after[0].isalpha() or after[0] in "¿¡")


def without(text: str, spans: list[tuple[int, int]], put: str = "") -> str:
    if not spans:
        return text
    parts, at = [], 0
    for a, b in sorted(spans):
        parts += [text[at:a], put]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def anchors(text: str) -> dict[str, str | None]:
    """Marks that a running header may hold, with the line they stand in (null in
    a flat text): two words around a sign, or a word and a number that no
    sentence mark follows. In lower case, without accents."""
    flat = is_flat(text)
    found: dict[str, str | None] = {}

    def put(anchor: str, at: int) -> None:
        line = None
        if not flat:
            end = text.find("\n", at)
            line = " ".join(text[text.rfind("\n", 0, at) + 1 : len(text) if end < 0 else end].translate(_FOLD).split())
        found[anchor.translate(_FOLD)] = line

    for m in _SIGN.finditer(text):
        a, b = _before_sign(text, m.start()), _WORD_AFTER.match(text, m.end())
        if a and b and not (a.isdigit() and b.group(1).isdigit()):
            put(f"{a} {m.group()} {b.group(1)}", m.start())
    for m in _NUMBER.finditer(text):
        a = _label_before(text, m.start())
        if a and not a.isdigit():
            put(f"{a} {m.group()}", m.start())
    return found


@dataclass
class Model:
    """Word and word-pair counts of unscanned text, and the log probability of
    each confusion (what is read, what stands there)."""

    words: dict[str, int]
    pairs: dict[tuple[str, str], int]
    total: int
    channel: dict[tuple[str, str], float] = field(default_factory=dict)
    _begun: set[str] = field(default_factory=set)
    _memo: dict[str, list[tuple[str, float]]] = field(default_factory=dict)
    _decoded: dict[tuple, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._begun = {w[:i] for w in self.words for i in range(len(w) + 1)}

    def alignments(self, read: str) -> dict[str, list[tuple[str, str]]]:
        """Known words that confusions turn into ``read``, each with its likeliest
        confusions. All digits must be explained."""
        found: dict[str, list[tuple[str, str]]] = {}
        if len(read) < 2 or not any(c.isalpha() for c in read) or _ORDINAL.match(read):
            return found
        most = max(MOST_EDITS, len(read) // 4)
        if sum(map(str.isdigit, read)) > most:
            return found
        stack: list[tuple[int, str, list[tuple[str, str]]]] = [(0, "", [])]
        while stack:
            i, made, edits = stack.pop()
            if made not in self._begun:
                continue
            if i == len(read):
                if edits and made in self.words and made != read and (made not in found or self._cost(edits) > self._cost(found[made])):
                    found[made] = edits
                continue
            if not read[i].isdigit():
                stack.append((i + 1, made + read[i], edits))
            if len(edits) < most:
                for width in (1, 2):
                    part = read[i : i + width]
                    if len(part) == width:
                        stack += [(i + width, made + true, [*edits, (part, true)]) for true in CONFUSIONS.get(part, ())]
        return found

    def _cost(self, edits: list[tuple[str, str]]) -> float:
        return sum(self.channel.get(x, CONFUSED) for x in edits)

    def candidates(self, read: str) -> list[tuple[str, float]]:
        """Known words that confusions turn into ``read``, with the channel's log probability."""
        if read not in self._memo:
            if len(self._memo) > 200_000:
                self._memo.clear()
            self._memo[read] = [(word, self._cost(edits)) for word, edits in self.alignments(read).items()]
        return self._memo[read]

    def log_p(self, word: str, before: str | None) -> float:
        """Likelihood of a word in its place. An unknown one is the less likely the
        more digits it has, as words are spelled without."""
        n = self.words.get(word)
        if n is None:
            alone, digits = 0.01 / (self.total + 1), sum(map(str.isdigit, word))
        else:
            alone, digits = (n + 0.01) / (self.total + 1), 0
        if before is None or before not in self.words:
            return math.log(alone) + digits * CONFUSED
        return math.log(0.7 * self.pairs.get((before, word), 0) / self.words[before] + 0.3 * alone) + digits * CONFUSED

    def decode(self, read: list[str], before: str | None = None, after: str | None = None) -> list[str]:
        """The most likely words behind neighbours that may be misread, by Viterbi,
        given the words around them."""
        best: dict[str | None, tuple[float, list[str]]] = {before: (0.0, [])}
        for word in read:
            step = {}
            for option, channel in [(word, 0.0), *self.candidates(word)]:
                score, path = max(((s + self.log_p(option, prior), p) for prior, (s, p) in best.items()), key=lambda x: x[0])
                step[option] = (score + channel, [*path, option])
            best = step
        if after is not None:
            best = {word: (s + self.log_p(after, word), path) for word, (s, path) in best.items()}
        return max(best.values(), key=lambda x: x[0])[1]

    def joined(self, left: str, sign: str, right: str, strict: bool = False) -> bool:
        """Whether the two parts are one divided word."""
        a, b = left.lower(), right.lower()
        if strict:
            return a + b in self.words and not (a in self.words and b in self.words)
        if f"{a}-{b}" in self.words and a + b not in self.words:
            return False
        if sign in "¬­" or a + b in self.words:
            return True
        return not (a in self.words and b in self.words) or bool(self.candidates(a + b))

    def mend_divided(self, text: str) -> tuple[str, int]:
        """The text with its divided words joined, and their number. Inside a line
        of an unflattened text only what makes a known word is joined."""
        parts, at, n = [], 0, 0
        flat = is_flat(text)
        for m in (_DIVIDED_FLAT if flat else _DIVIDED_ANY).finditer(text):
            left, right = _ENDING.search(text, max(at, _word_start(text, m.start())), m.start()), _BEGINNING.match(text, m.end())
            if left and self.joined(left.group(), m.group()[0], right.group(), not flat and "\n" not in m.group()):
                parts.append(text[at : m.start()])
                at, n = m.end(), n + 1
        return ("".join([*parts, text[at:]]) if n else text), n

    def decode_known(self, read: list[str], before: str | None, after: str | None) -> list[str]:
        """``decode``, once for each case of a few words, so that those kept stay small.
        Of an unknown word before nothing bears on the result, of one after its
        number of digits only."""
        if len(read) > 8:
            return self.decode(read, before, after)
        if before not in self.words:
            before = None
        if after is not None and after not in self.words:
            after = "0" * sum(map(str.isdigit, after))
        case = (before, after, *read)
        if case not in self._decoded:
            if len(self._decoded) > 100_000:
                self._decoded.clear()
            self._decoded[case] = self.decode(read, before, after)
        return self._decoded[case]

    def misread(self, text: str, apply: bool = False) -> tuple[str, int]:
        """The text with its misread words mended, and their number; without
        ``apply`` the search ends at the first."""
        lower = text.lower()
        if len(lower) != len(text):
            lower = text
        # what stands between, a word, what stands between, ...; a line end around it all
        parts = _TOKENS.split(f"\n{_without_addresses(text, lower)}\n")
        doubtful = {w for w in set(parts[1::2]) if not w.isdigit() and self.candidates(w)}
        if not doubtful:
            return text, 0
        between, words = parts[0::2], parts[1::2]
        starts = list(accumulate(map(len, parts), initial=-1))[1::2] if apply else []
        changed, put, at, end = 0, [], 0, 0
        # a word of one reading only divides the line: what is before it doesn't bear on what comes after
        for i in [i for i, w in enumerate(words) if w in doubtful]:
            if i < end or not (len(words[i]) >= LEAST_LENGTH or _stands_free(between[i], between[i + 1])):
                continue
            end = i + 1
            while "\n" not in between[end] and words[end] in doubtful and (len(words[end]) >= LEAST_LENGTH or _stands_free(between[end], between[end + 1])):
                end += 1
            read = words[i:end]
            best = self.decode_known(read, None if "\n" in between[i] else words[i - 1], None if "\n" in between[end] else words[end])
            if best == read:
                continue
            if not apply:
                return text, 1
            for k, (was, now) in enumerate(zip(read, best, strict=True), i):
                if was != now:
                    changed += 1
                    put += [text[at : starts[k]], _like(text[starts[k] : starts[k] + len(was)], now)]
                    at = starts[k] + len(was)
        return "".join([*put, text[at:]]), changed


def _without_addresses(text: str, lower: str) -> str:
    """The text in lower case, with _ for each character of the runs that hold a
    sign of addresses."""
    parts, at = [], 0
    for m in _ADDRESS_SIGN.finditer(text):
        if m.start() < at:
            continue
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        end = _BLANK.search(text, m.end()).start()
        parts += [lower[at:start], "_" * (end - start)]
        at = end
    return "".join([*parts, lower[at:]]) if parts else lower


def _stands_free(before: str, after: str) -> bool:
    """Whether a short word between the two is no piece of a code."""
    return bool(_BEFORE_FREE.match(before[-1]) and _AFTER_FREE.match(after))


def _like(read: str, word: str) -> str:
    if read.isupper() and len(read) > 1:
        return word.upper()
    return word[0].upper() + word[1:] if read[0].isupper() else word


def noise_kinds(text: str, model: Model) -> list[str]:
    """The kinds of noise in one text but the header, which needs the file."""
    kinds = []
    pages = page_numbers(text)
    if pages:
        kinds.append("page_no")
        text = without(text, pages)
    text, divided = model.mend_divided(text)
    if divided:
        kinds.append("hyphen")
    if model.misread(text)[1]:
        kinds.append("misread")
    return kinds


def repair(text: str, model: Model, header: list[tuple[str, str | None]] = ()) -> str:
    """The text as continuous paragraphs, without header and page numbers.
    ``header``: (anchor, line) of the file's running header."""
    text = without(text, page_numbers(text), "")
    text = without_header(text, header)
    text = model.misread(model.mend_divided(text)[0], apply=True)[0]
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n[ \t]*\n", text)]
    return "\n\n".join(p for p in paragraphs if p)


def _loose(words: str) -> str:
    return r"\s+(?:n[°º]\s*)?".join(map(re.escape, words.split()))


def without_header(text: str, header: list[tuple[str, str | None]]) -> str:
    bare = text.translate(_FOLD)
    spans: list[tuple[int, int]] = []
    for anchor, line in header:
        if is_flat(text):
            spans += [m.span() for m in re.finditer(rf"(?<!\S){_loose(line or anchor)}(?!\S)\s?", bare)]
        else:
            spans += [m.span() for m in re.finditer(rf"^[^\n]*{_loose(anchor)}[^\n]*$\n?", bare, re.M)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if not merged or a >= merged[-1][1]:
            merged.append((a, b))
    return without(text, merged, "")


def chunk_texts(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """(chunk_id, file_id, text, scanned) of the latest rows, written by ``scanned``:
    whether the page at page_start was. Which rows are the latest and which
    pages were scanned is found without the text, so the text is shuffled once.
    Rows that tie are copies of each other and may stay several."""
    newest = latest(chunks.select("chunk_id", "file_id", "page_start", "updated_at"), ["chunk_id"])
    page = latest(pages.select("file_id", "page_number", "method", "updated_at"), ["file_id", "page_number"])
    page = page.filter(F.col("method").isin(SCANNED)).select("file_id", F.col("page_number").alias("page_start"), F.lit(True).alias("scanned"))
    keys = newest.join(page, ["file_id", "page_start"], "left").select("chunk_id", F.col("updated_at").alias("at"), F.coalesce("scanned", F.lit(False)).alias("scanned"))
    rows = hashed(chunks.filter("text is not null").select("chunk_id", "file_id", "text", "updated_at"), "chunk_id")
    texts = rows.join(hashed(keys, "chunk_id"), "chunk_id").filter(F.col("updated_at").eqNullSafe(F.col("at"))).drop("updated_at", "at")
    path = scratch_path(chunks.sparkSession, "texts")
    texts.write.partitionBy("scanned").parquet(path)
    return chunks.sparkSession.read.schema(texts.schema).parquet(path)


def count_words(texts: DataFrame) -> DataFrame:
    """(scanned, a, b, n): how often word b follows a, and word b alone where a is
    null; in scanned texts words only. Counted in blocks within the tasks, so
    the shuffle holds words and not text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pairs, read = Counter(), Counter(), Counter()

        def flush() -> pd.DataFrame:
            rows = [(False, None, w, n) for w, n in words.items()] + [(False, a, b, n) for (a, b), n in pairs.items()]
            rows += [(True, None, w, n) for w, n in read.items()]
            for counter in (words, pairs, read):
                counter.clear()
            return pd.DataFrame(rows, columns=["scanned", "a", "b", "n"])

        for batch in batches:
            for text, scanned in zip(batch["text"], batch["scanned"], strict=True):
                if scanned:
                    read.update(_TOKEN.findall(text.lower()))
                    continue
                found = _COUNTED.findall(_without_divided(text).lower())
                words.update(found)
                pairs.update(zip(found, found[1:], strict=False))
            if len(pairs) + len(read) > 1_000_000:
                yield flush()
        yield flush()

    counted = spread(texts.select("text", "scanned")).mapInPandas(count, "scanned boolean, a string, b string, n long")
    return counted.groupBy("scanned", "a", "b").agg(F.sum("n").alias("n"))


def fit_model(texts: DataFrame) -> Model:
    """The corpus' language model, from all unscanned text, and its channel, from
    all words of scanned text. The model's size is bounded by the shares,
    whatever the corpus, that of the channel by the confusions there are."""
    counts = written(count_words(texts), "words")
    clean = counts.filter("not scanned")
    total = clean.filter("a is null").agg(F.sum("n")).first()[0] or 0
    kept = clean.filter(
        (F.col("a").isNull() & (F.col("n") >= max(2, total * WORD_SHARE))) | (F.col("a").isNotNull() & (F.col("n") >= max(2, total * PAIR_SHARE)))
    )
    words, pairs = {}, {}
    for _, a, b, n in kept.toLocalIterator():
        if a is None:
            words[b] = n
        else:
            pairs[a, b] = n
    pairs = {k: n for k, n in pairs.items() if k[0] in words and k[1] in words}
    return Model(words, pairs, total, estimate_channel(counts.filter("scanned").select("b", "n"), Model(words, {}, total)))


def estimate_channel(read: DataFrame, model: Model) -> dict[tuple[str, str], float]:
    """Log probabilities of the confusions, from the distinct words (b, n) of scanned
    text: those that are unknown and come of one known word are aligned with
    it, and each confusion is counted against the places where its right
    characters were read as they are."""
    shared = read.sparkSession.sparkContext.broadcast(model)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, wrong, right = shared.value, Counter(), Counter()
        trues = {true for some in CONFUSIONS.values() for true in some}
        for batch in batches:
            for word, n in zip(batch["b"], batch["n"], strict=True):
                if word in known.words:
                    for true in trues:
                        if true in word:
                            right[true] += n * word.count(true)
                elif len(word) >= LEAST_LENGTH and len(found := known.alignments(word)) == 1:
                    for edit in next(iter(found.values())):
                        wrong[edit] += n
        rows = [(a, b, n) for (a, b), n in wrong.items()] + [(None, b, n) for b, n in right.items()]
        yield pd.DataFrame(rows, columns=["part", "true", "n"])

    counted = read.mapInPandas(align, "part string, true string, n long").groupBy("part", "true").agg(F.sum("n").alias("n")).collect()  # a row a confusion
    right = {r["true"]: r["n"] for r in counted if r["part"] is None}
    wrong = {(r["part"], r["true"]): r["n"] for r in counted if r["part"] is not None}
    every = [(part, true) for part, some in CONFUSIONS.items() for true in some]
    # twenty places' worth of the value assumed before
    return {x: math.log((wrong.get(x, 0) + 20 * math.exp(CONFUSED)) / (right.get(x[1], 0) + wrong.get(x, 0) + 20)) for x in every}


def noise_marks(scanned: DataFrame, model: Model | None) -> DataFrame:
    """(chunk_id, file_id, kind, anchor, line): kinds found in the text itself,
    and the anchors a header may have (kind null). Without a model, the anchors only."""
    shared = scanned.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            rows = []
            for chunk, file, text in zip(batch["chunk_id"], batch["file_id"], batch["text"], strict=True):
                if known is not None:
                    rows += [(chunk, file, kind, None, None) for kind in noise_kinds(text, known)]
                rows += [(chunk, file, None, a, line) for a, line in anchors(without(text, page_numbers(text))).items()]
            yield pd.DataFrame(rows, columns=["chunk_id", "file_id", "kind", "anchor", "line"])

    return scanned.mapInPandas(run, "chunk_id string, file_id string, kind string, anchor string, line string")


#: a header is so unlikely to come as often in a file by chance
CHANCE = 1e-5
#: a mark on this share of a file's chunks is likely that file's own header
OWN_SHARE = 0.25


def _log_factorial(k: Column) -> Column:
    """ln k!, exact to 20 and by Stirling's series beyond."""
    k = k.cast("double")
    series = k * F.log(k) - k + 0.5 * F.log(2 * math.pi * k) + 1 / (12 * k)
    return F.when(k <= 20, F.log(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def header_anchors(marks: DataFrame, chunks_of_file: DataFrame) -> DataFrame:
    """(file_id, anchor) of running headers: on at least three chunks of the
    file, and far more often than by chance. The chance of that number is
    bounded by a Poisson tail with the rate outside the file; files that have
    the mark as a header of their own tell nothing of chance and aren't counted."""
    seen = marks.filter("anchor is not null").select("file_id", "anchor", "chunk_id").distinct()
    own = seen.groupBy("file_id", "anchor").agg(F.count("*").alias("k")).join(chunks_of_file, "file_id")
    own = own.withColumn("stray", F.when((F.col("k") >= 3) & (F.col("k") >= OWN_SHARE * F.col("n")), 0).otherwise(F.col("k")))
    everywhere = own.groupBy("anchor").agg(F.sum("stray").alias("all"))
    total = chunks_of_file.agg(F.sum("n").alias("total"))
    rate = (F.col("all") - F.col("stray") + 0.5) / (F.col("total") - F.col("n") + 1)
    expected = F.col("n") * rate
    log_tail = F.col("k") * F.log(expected) - expected - _log_factorial(F.col("k"))
    return (
        own.filter("k >= 3")
        .join(everywhere, "anchor")
        .crossJoin(F.broadcast(total))  # one row
        .filter((log_tail < math.log(CHANCE)) & (expected < F.col("k") / 2))
        .select("file_id", "anchor")
    )


def _marks_and_headers(chunks: DataFrame, pages: DataFrame, kinds: bool = True) -> tuple[DataFrame, Model, DataFrame, DataFrame]:
    texts = chunk_texts(chunks, pages)
    model, scanned = fit_model(texts), spread(texts.filter("scanned").select("chunk_id", "file_id", "text"))
    marks = written(noise_marks(scanned, model if kinds else None), "marks")
    newest = latest(chunks.select("chunk_id", "file_id", "updated_at"), ["chunk_id"])
    return scanned, model, marks, header_anchors(marks, newest.groupBy("file_id").agg(F.count("*").alias("n")))


def found_noise(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """(chunk_id, noise_kind) of chunks of scanned pages, once a kind.

    Null and empty texts have no noise; chunks without a page row are not of a
    scanned page. Repeated rows count once. Extra columns are not read.
    """
    _, _, marks, headers = _marks_and_headers(chunks, pages)
    on_chunks = marks.filter("anchor is not null").join(headers, ["file_id", "anchor"]).select("chunk_id", F.lit("header").alias("noise_kind"))
    return marks.filter("kind is not null").select("chunk_id", F.col("kind").alias("noise_kind")).unionByName(on_chunks).distinct()


def repaired(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """(chunk_id, text) of chunks of scanned pages, as readable paragraphs.

    The header's whole line is the most frequent one with the anchor in the
    file; where all of a file's chunks are flat, the anchor alone is removed.
    """
    scanned, model, marks, headers = _marks_and_headers(chunks, pages, kinds=False)
    lines = written(
        marks.filter("anchor is not null")
        .join(headers, ["file_id", "anchor"])
        .groupBy("file_id", "anchor", "line")
        .agg(F.count("*").alias("n"))
        .groupBy("file_id", "anchor")
        .agg(F.max_by("line", F.struct(F.col("line").isNotNull(), "n", "line")).alias("line"))
        .groupBy("file_id")
        .agg(F.collect_list(F.struct("anchor", "line")).alias("header")),
        "headers",
    )
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            texts = []
            for text, header in zip(batch["text"], batch["header"], strict=True):
                header = [] if header is None else [(h["anchor"], h["line"]) for h in header]
                texts.append(repair(text, known, header))
            yield pd.DataFrame({"chunk_id": batch["chunk_id"], "text": texts})

    # few files have a header beside the texts they hold: broadcast if counted to be few, else joined with hot files split by AQE
    rows = scanned.join(bounded_broadcast(lines), "file_id", "left").select("chunk_id", "text", "header")
    return rows.mapInPandas(run, "chunk_id string, text string").dropDuplicates(["chunk_id"])
