"""Byte-pair encoding and decoding of whole texts.

A text is cut into words by the vocabulary's pattern.  Each different word of a
task is encoded once: a short word by a contiguous array of part boundaries
with the merge ranks of adjacent parts beside it - the smallest rank is found by
a scan, its boundary is deleted and the two neighbouring ranks are looked up
again.  A scan costs the length of the word, so a long word uses a heap of the
same ranks over linked parts instead; both make the same merges in the same
order.  Ids become text again by the bytes each id stands for.

A null text is empty and has no ids.  Texts of any length are encoded whole;
rows are independent, so ties, repeats and other columns have no effect, and an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wavemeld.llm.common import fresh

#: Words of up to this many bytes are merged by scans, longer ones by a heap.
SHORT_WORD = 128
#: Different words a task remembers; when it has more it starts anew.
REMEMBERED = 400_000
NO_MERGE = 1 << 30


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file.

    Printable bytes of Latin-1 stand for themselves, the others in turn for the
    code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class Vocabulary:
    """What a byte-level vocabulary file says, in the form the merges need."""

    pattern: str
    #: The id of each single byte.
    single: tuple[int, ...]
    #: ``left << 32 | right`` of two ids: the rank of their merge.
    ranks: dict[int, int]
    #: The id that a merge of this rank makes.
    made: tuple[int, ...]
    #: The bytes of each id.
    pieces: dict[int, bytes]
    #: Strings that are one id wherever they stand.
    special: dict[str, int]


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    letters = byte_letters()
    ids = rules["model"]["vocab"]
    pieces = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
    by_byte = {piece[0]: i for i, piece in pieces.items() if len(piece) == 1}
    ranks, made = {}, []
    for rank, (left, right) in enumerate(rules["model"]["merges"]):
        ranks.setdefault(ids[left] << 32 | ids[right], rank)
        made.append(ids[left + right])
    special = {t["content"]: t["id"] for t in rules["added_tokens"]}
    pieces |= {i: text.encode() for text, i in special.items()}
    return Vocabulary(pattern, tuple(by_byte[b] for b in range(256)), ranks, tuple(made), pieces, special)


def merge_short(word: bytes, v: Vocabulary) -> list[int]:
    """Ids of a word, by scans over its boundaries and the ranks between them."""
    parts = [v.single[b] for b in word]
    ranks, made = v.ranks, v.made
    # near[i] is the rank of merging part i with the one after it, i.e. of deleting the boundary between them.
    near = [ranks.get(a << 32 | b, NO_MERGE) for a, b in zip(parts, parts[1:])]
    while near:
        best = min(near)
        if best == NO_MERGE:
            break
        i = near.index(best)
        parts[i] = made[best]
        del parts[i + 1], near[i]
        if i:
            near[i - 1] = ranks.get(parts[i - 1] << 32 | parts[i], NO_MERGE)
        if i < len(near):
            near[i] = ranks.get(parts[i] << 32 | parts[i + 1], NO_MERGE)
    return parts


def merge_long(word: bytes, v: Vocabulary) -> list[int]:
    """The same ids as :func:`merge_short`, in a time that grows little faster than the word."""
    parts = [v.single[b] for b in word]
    n = len(parts)
    after, before, ranks = list(range(1, n + 1)), list(range(-1, n - 1)), v.ranks
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
            if (r := ranks.get(parts[i] << 32 | parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        # An entry whose parts have been merged since is void; a part that is gone has the id -1.
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j] = v.made[rank], -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(parts[a] << 32 | parts[b])) is not None:
                heapq.heappush(heap, (r, a, parts[a], parts[b]))
    return [p for p in parts if p >= 0]


class Coder(dict):
    """Remembers the ids of words, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.v = vocabulary
        self.words = regex.compile(vocabulary.pattern).findall
        # Of two special strings at one place the longer one counts.
        marks = sorted(vocabulary.special, key=lambda s: (-len(s), s))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        size = max(vocabulary.pieces) + 1
        self.pieces = [vocabulary.pieces.get(i, b"") for i in range(size)]

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        ids = merge_short(raw, self.v) if len(raw) <= SHORT_WORD else merge_long(raw, self.v)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= SHORT_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed."""
        if self.marks is None or not self.marks.search(text):
            return b"".join(map(self.__getitem__, self.words(text)))
        out = []
        for i, part in enumerate(self.marks.split(text)):
            out.append(struct.pack("<I", self.v.special[part]) if i % 2
                       else b"".join(map(self.__getitem__, self.words(part))))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column.cast(pa.large_binary()):
        raw = value.as_py()
        yield "" if raw is None else raw.decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: the ids of each whole text; a column of that name is shadowed by a longer one."""
    out = fresh(docs, "ids")
    return _map_text(docs, vocabulary, pattern, text, [(out, "array<int>", pa.list_(pa.int32()))], _ids)


def _ids(coder: Coder, text: str) -> tuple:
    return (np.frombuffer(coder.encode(text), "<u4").astype(np.int32),)


def round_trips(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text, encoded and decoded."""
    columns = [("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()),
               ("decoded_sha256", "string", pa.string())]
    narrow = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    return _map_text(narrow, vocabulary, pattern, "text", columns, _digests).drop("text")


def _digests(coder: Coder, text: str) -> tuple:
    packed = coder.encode(text)
    return (len(packed) // 4, hashlib.sha256(packed).hexdigest(),
            hashlib.sha256(coder.decode(packed).encode("utf-8")).hexdigest())


def _map_text(docs: DataFrame, vocabulary: str, pattern: str, text: str, columns: list, work) -> DataFrame:
    """``docs`` with what ``work`` makes of each text, in one pass without a shuffle."""
    names = [c for c, _, _ in columns]
    place = docs.columns.index(text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] +
                       [f"`{c}` {kind}" for c, kind, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load_vocabulary(vocabulary, pattern))
        for batch in batches:
            made = [work(coder, t) for t in _texts(batch.column(place))]
            new = [pa.array([row[i] for row in made], kind) for i, (_, _, kind) in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
