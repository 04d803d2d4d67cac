"""Evaluation texts leaking into training text, by winnowed fingerprints.

Texts are compared as words without case, accents and punctuation. Of every
window of neighbouring word k-grams the one with the least hash is kept, so any
shared span of WINDOW + GRAM - 1 = 3 words has a fingerprint in common. A stretch
of 15 words with three edits, the most that one word in six allows, keeps a run
of three equal words, as longer ones do, so every leak has a hit. Each hit is
extended in both texts by an alignment that allows changed, missing and added
words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cernido.tables import spread

#: no larger, or leaks with evenly spread edits would go without a hit
GRAM = 2
WINDOW = 2
#: a leak covers so many words of the item, or the whole passage if that is shorter
LEAST_WORDS = 15
#: at most this share of a leak's words may be changed, missing or added
MOST_EDITS = 1 / 6
#: items are taken in blocks of so many words, which bounds what is broadcast
BLOCK_WORDS = 2_000_000

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", chr(code))
        value = self[code] = "".join(c for c in parts if not unicodedata.combining(c) and unicodedata.category(c) != "Cf").lower()
        return value


_FOLD = _Fold()


def _latin_table() -> tuple[bytes, re.Pattern]:
    """The fold of Latin-1 byte for byte, all but letters and digits as blanks,
    and the characters whose fold is longer."""
    plain, longer = bytearray(b" " * 256), []
    for i in range(256):
        folded = _FOLD[i]
        if _WORD.fullmatch(folded):
            if len(folded) == 1 and ord(folded) < 256:
                plain[i] = ord(folded)
            else:
                longer.append(chr(i))
        elif _WORD.search(folded) or not folded:
            longer.append(chr(i))
    return bytes(plain), re.compile(f"[{re.escape(''.join(longer))}]")


_LATIN, _NOT_BY_BYTE = _latin_table()
#: typographic signs, which no word holds
_SIGNS = re.compile("[\u2010-\u2027\u2030-\u205e\u20ac]")


def words(text: str | None) -> list[str]:
    """The words of a text without case, accents and punctuation. Latin text goes
    through a table of bytes."""
    if not text:
        return []
    try:
        if not text.isascii() and _NOT_BY_BYTE.search(text):
            return _WORD.findall(text.translate(_FOLD))
        return _SIGNS.sub(" ", text).encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text.translate(_FOLD))


def gram_hashes(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of GRAM word numbers."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        value = (value ^ (ids[i : i + n].astype(np.uint64) + np.uint64(1))) * _MIX
        value ^= value >> np.uint64(29)
    return value


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Positions of the k-grams that are the least of a window of WINDOW."""
    n = len(hashes)
    if n <= WINDOW:
        return np.array([int(np.argmin(hashes))]) if n else np.zeros(0, dtype=np.int64)
    first = np.arange(n - WINDOW + 1)
    best = first
    for i in range(1, WINDOW):
        best = np.where(hashes[first + i] < hashes[best], first + i, best)
    kept = np.zeros(n, dtype=bool)
    kept[best] = True
    return np.flatnonzero(kept)


def _runs(values: np.ndarray, n: int) -> np.ndarray:
    """All runs of n neighbours, as a view."""
    return np.lib.stride_tricks.as_strided(values, (len(values) - n + 1, n), values.strides * 2)


#: hits are weighed against the text in blocks of so many, which bounds the memory for a long text
HITS_AT_ONCE = 8192


@dataclass
class Index:
    """Fingerprints of a block of test items. ``flat`` has the words of all items
    with blanks between; ``base`` is where each item starts in it."""

    vocabulary: dict[str, int]
    items: list[tuple[int, np.ndarray]]
    hashes: np.ndarray
    owner: np.ndarray
    at: np.ndarray
    flat: np.ndarray
    base: np.ndarray
    least: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple[int, str]]) -> Index:
        vocabulary: dict[str, int] = {}
        items, hashes, owner, at = [], [], [], []
        blank = np.full(LEAST_WORDS + GRAM, -1, dtype=np.int32)
        flat, base, size = [blank], [], len(blank)
        for item_id, passage in rows:
            ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(passage)], dtype=np.int64)
            grams = gram_hashes(ids)
            kept = winnow(grams)
            hashes.append(grams[kept])
            owner.append(np.full(len(kept), len(items), dtype=np.int64))
            at.append(kept)
            items.append((item_id, ids))
            flat += [ids, blank]
            base.append(size)
            size += len(ids) + len(blank)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        order = np.argsort(joined, kind="stable")
        empty = np.zeros(0, dtype=np.int64)
        need = np.array([min(LEAST_WORDS, len(ids)) for _, ids in items], dtype=np.int64)
        return cls(
            vocabulary, items, joined[order], (np.concatenate(owner) if owner else empty)[order], (np.concatenate(at) if at else empty)[order],
            np.concatenate(flat).astype(np.int32), np.array(base, dtype=np.int64), need - (need * MOST_EDITS + 0.5).astype(np.int64),
        )

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the text, position in the item, item) of shared fingerprints
        that are worth extending."""
        grams = gram_hashes(ids)
        none = np.zeros(0, dtype=np.int64)
        if not len(grams) or not len(self.hashes):
            return none, none, none
        kept = winnow(grams)
        mine = grams[kept]
        low = np.searchsorted(self.hashes, mine)
        shared = np.nonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == mine)[0]
        if not len(shared):
            return none, none, none
        low = low[shared]
        times = np.searchsorted(self.hashes, mine[shared], side="right") - low
        place = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        p, q, owner = np.repeat(kept[shared], times), self.at[place], self.owner[place]
        good = np.concatenate([self.worth_extending(ids, p[i : i + HITS_AT_ONCE], q[i : i + HITS_AT_ONCE], owner[i : i + HITS_AT_ONCE]) for i in range(0, len(p), HITS_AT_ONCE)])
        return p[good], q[good], owner[good]

    def worth_extending(self, text: np.ndarray, p: np.ndarray, q: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether some LEAST_WORDS item words around each hit can be a leak: all
        but its edits must have their like at most as many words off the hit's
        diagonal. All hits are weighed together."""
        edits = int(LEAST_WORDS * MOST_EDITS + 0.5)
        span = 2 * LEAST_WORDS + GRAM - 2
        margin = np.full(LEAST_WORDS + edits, -(1 << 31), dtype=np.int32)
        padded = np.concatenate([margin, text.astype(np.int32), margin, margin])
        part = _runs(self.flat, span)[self.base[owner] + q - (LEAST_WORDS - 1)]
        near = _runs(padded, span + 2 * edits)[p + len(margin) - (LEAST_WORDS - 1) - edits]
        same = part == near[:, :span]
        for shift in range(1, 2 * edits + 1):
            same |= part == near[:, shift : shift + span]
        sums = np.cumsum(same, axis=1, dtype=np.int8)
        best = np.maximum(sums[:, LEAST_WORDS - 1], (sums[:, LEAST_WORDS:] - sums[:, :-LEAST_WORDS]).max(axis=1))
        return best >= self.least[owner]

    def leaks(self, text_words: list[str]) -> list[tuple[int, int, int, int]]:
        """(item_id, words covered in the item, edits, first word of the text)."""
        ids = np.fromiter(map(self.vocabulary.get, text_words, repeat(-1)), dtype=np.int64, count=len(text_words))
        if np.count_nonzero(ids >= 0) < GRAM:
            return []
        ids = np.where(ids < 0, -2 - np.arange(len(ids)), ids)  # unknown words equal nothing
        by_item: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for p, q, item in zip(*map(np.ndarray.tolist, self.hits(ids)), strict=True):
            by_item[item].append((p, q))
        stretches = []
        for item, pairs in by_item.items():
            stretches += [Stretch(item, *x) for x in stretches_of(ids, self.items[item][1], pairs)]
        best: dict[int, Stretch] = {}
        for one in self.unowned(ids, stretches):
            if one.item not in best or one.covered > best[one.item].covered:
                best[one.item] = one
        return [(self.items[x.item][0], x.covered, x.edits, x.first) for x in best.values()]

    def unowned(self, text: np.ndarray, stretches: list[Stretch]) -> list[Stretch]:
        """The stretches of one text without those that lie within a stretch of
        another item with clearly fewer edits: items made alike share their
        common phrases. Items that fit about as well are all kept."""
        kept = []
        for one in stretches:
            if one.edits >= CLEARLY_FEWER:
                part = text[one.first : one.last + 1]
                rivals = {x.item for x in stretches if x.item != one.item and x.first - LOOSE_END <= one.first and one.last <= x.last + LOOSE_END}
                if any(edits_within(part, self.items[x][1]) <= one.edits - CLEARLY_FEWER for x in rivals):
                    continue
            kept.append(one)
        return kept


@dataclass(frozen=True)
class Stretch:
    """A leak of one item (by its place in the block): item words covered, edits,
    first and last word of the text."""

    item: int
    covered: int
    edits: int
    first: int
    last: int


#: a rival owns a stretch that it fits with so many edits less, but for so many words at either end
CLEARLY_FEWER = 2
LOOSE_END = 2


def edits_within(part: np.ndarray, item: np.ndarray) -> int:
    """The least edits that make some run of the item's words of the part."""
    places = np.arange(len(item) + 1)
    row = np.zeros(len(item) + 1, dtype=np.int64)
    for i, word in enumerate(part):
        step = np.concatenate([[i + 1], np.minimum(row[1:] + 1, row[:-1] + (item != word))])
        row = np.minimum.accumulate(step - places) + places
    return int(row.min())


def stretches_of(text: np.ndarray, item: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """All stretches that the hits extend to and that are leaks:
    (item words covered, edits, first and last word of the text)."""
    need = min(LEAST_WORDS, len(item))
    found = set()
    # hits on one band of the alignment are tried once
    tried: list[tuple[int, int, int]] = []
    for p, q in sorted(hits):
        if any(a <= p <= b and abs((p - q) - d) <= 12 for a, b, d in tried):
            continue
        covered, edits, first, last = extend(text, item, p, q)
        tried.append((first, last, p - q))
        if covered >= need and edits <= covered * MOST_EDITS + 0.5:
            found.add((covered, edits, first, last))
    return sorted(found)


def extend(text: np.ndarray, item: np.ndarray, p: int, q: int) -> tuple[int, int, int, int]:
    """Extends a hit both ways: (item words covered, edits, first and last text word)."""
    right_q, right_p, right_edits = _one_way(text[p + GRAM :], item[q + GRAM :])
    left_q, left_p, left_edits = _one_way(text[:p][::-1], item[:q][::-1])
    return GRAM + right_q + left_q, right_edits + left_edits, p - left_p, p + GRAM + right_p - 1


#: a match earns one, an edit costs this; a branch this far below its best is given up
EDIT_COST, GIVE_UP = 3, 9
#: longest run of added or missing words; words past the second of a run cost one each.
#: A leak with a longer run has 15 words on one side and is found by these
MOST_RUN = 5


def _run_cost(n: int) -> int:
    return EDIT_COST * min(n, 2) + max(0, n - 2)


def _one_way(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """The best scoring common beginning: (item words, text words, edits).

    A banded alignment over item words; state: offset between the two -> (score, edits).
    """
    band = {0: (0, 0)}
    earlier: list[dict[int, tuple[int, int]]] = []  # the bands of the last words, for runs of missing words
    best, best_score = (0, 0, 0), 0
    n, m = len(text), len(item)
    for i in range(m):
        word = item[i]
        earlier = [band, *earlier[:MOST_RUN]]
        step: dict[int, tuple[int, int]] = {}
        for offset, (score, edits) in band.items():
            j = i + offset
            if 0 <= j < n and text[j] == word:
                _keep(step, offset, score + 1, edits)
            else:
                if j < n:
                    _keep(step, offset, score - EDIT_COST + 1, edits + 1)  # changed
                _keep(step, offset - 1, score - EDIT_COST, edits + 1)  # missing in the text
                for added in range(1, MOST_RUN + 1):
                    if 0 <= j + added < n and text[j + added] == word:
                        _keep(step, offset + added, score + 1 - _run_cost(added), edits + added)
        for missing in range(3, len(earlier)):
            for offset, (score, edits) in earlier[missing].items():
                j = i - missing + offset
                if 0 <= j < n and text[j] == word:
                    _keep(step, offset - missing, score + 1 - _run_cost(missing), edits + missing)
        top = max((s for s, _ in step.values()), default=-1)
        band = {o: v for o, v in step.items() if v[0] >= max(top - GIVE_UP, best_score - GIVE_UP)}
        if not band:
            if not any(earlier[:MOST_RUN]):
                break
            continue
        offset, (score, edits) = max(band.items(), key=lambda x: (x[1][0], -abs(x[0])))
        if score > best_score:
            best_score, best = score, (i + 1, i + 1 + offset, edits)
    return best


def _keep(step: dict[int, tuple[int, int]], offset: int, score: int, edits: int) -> None:
    if offset not in step or step[offset][0] < score:
        step[offset] = (score, edits)


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int32()), ("edits", pa.int32())])


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of bounded size, read one by one."""
    block, size = [], 0
    for item_id, passage in items.filter("passage is not null").select("item_id", "passage").toLocalIterator():
        block.append((item_id, passage))
        size += len(passage) // 4
        if size > BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_words, edits): documents that hold an item's passage
    or a stretch of at least 15 of its words, with up to one word in six
    changed, missing or added; the longest stretch of each pair.

    Documents are read once a block of items and never shuffled; the
    fingerprints of a block are joined within the tasks. Null and empty texts
    and passages leak nothing; repeated documents are reported each.
    """
    spark = docs.sparkSession
    rows = spread(docs.filter("text is not null").select("doc_id", "text"))
    found = None
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(Index.build(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                out = []
                for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    out += [(doc, item, covered, edits) for item, covered, edits, _ in index.leaks(words(text))]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * 4, FOUND.types, strict=True)], schema=FOUND)

        part = rows.mapInArrow(run, "doc_id long, item_id long, item_words int, edits int")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, item_words int, edits int")
    return found


def leaks_by_item(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, documents): in how many documents each leaked item was found."""
    return leaked(docs, items).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"))
