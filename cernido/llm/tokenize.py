"""Encoding a corpus with a public byte-level BPE vocabulary.

A pretoken's merges run on a segment tree over its byte positions. A leaf holds
the rank of the pair that starts there, an inner node the leftmost minimum of
its children, so the next merge is read at the root and costs a few point
updates of logarithmic depth on the live neighbours, however long the pretoken.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cernido.tables import spread

#: where the vocabulary files lie, unless a path is given
TOKENIZER_DIR = os.environ.get("CERNIDO_TOKENIZERS", "/opt/tokenizers")

#: The published pattern that splits text before the merges (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NONE = 1 << 62


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pretoken: always merges the leftmost pair of least rank."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    base = 1
    while base < n - 1:
        base *= 2
    tree = [_NONE] * (2 * base)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[base + i] = rank << 32 | i
    for node in range(base - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def put(i: int, value: int) -> None:
        node = base + i
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a < b else b
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    def pair(i: int) -> int:
        j = after[i]
        if j >= n:
            return _NONE
        rank = ranks.get(parts[i] + parts[j])
        return _NONE if rank is None else rank << 32 | i

    while (least := tree[1]) != _NONE:
        i = least & 0xFFFFFFFF
        j = after[i]
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if j < n - 1:
            put(j, _NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    return [ranks[p] for p in parts if p is not None]


class Encoder:
    """Text to ids. Pretokens that come again are taken from a bounded table."""

    def __init__(self, vocabulary: str, table_size: int = 300_000):
        import regex

        with open(vocabulary, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._split = regex.compile(PATTERN).findall
        self._known: dict[str, list[int]] = {}
        self._table_size = table_size

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self._known, []
        for piece in self._split(text):
            ids = known.get(piece)
            if ids is None:
                ids = merge(piece.encode("utf-8", "replace"), self.ranks)
                if len(piece) <= 64:
                    if len(known) >= self._table_size:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row, no shuffle but to fill idle cores.

    An empty and a null text have an empty list. Repeated ids and repeated
    texts are encoded each on its own. Columns beyond the two are not read.
    The vocabulary file must lie at the same path on every executor.
    """
    path = vocabulary or f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            offsets, flat = [0], []
            for text in batch.column(1).to_pylist():
                flat += encoder.encode(text)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    two = spread(docs.select(id_col, text_col))
    schema = T.StructType([two.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), True), True)])
    return two.mapInArrow(run, schema)
