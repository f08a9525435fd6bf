"""Repeated byte strings across all texts, by sorting suffixes.

Of the suffixes of all texts only those at anchors are told apart first: the
anchor of a 400-byte string is its 64-byte token of smallest hash, so equal
strings have equal anchors at equal places, and one anchor stands for all the
strings around it (a block).  Anchors whose token occurs once are done.  The
blocks of the others are range-partitioned by sampled splitters on their
leading token; each bucket sorts the suffixes that its blocks begin by multikey
quicksort, and neighbours that agree in 400 bytes are repeats.  Equal tokens
have equal keys, so no boundary of the splitters can part two equal strings.  A
token with more different blocks than a task should sort (a phrase of a large
part of all texts, in different surroundings) is not sorted in one place: the
strings of its blocks are named by a digest and counted over all tasks, and the
blocks ask for the names that occur more than once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.llm import tokens
from wavemeld.llm.common import settle

LENGTH = 400
TOKEN = 64
#: Different blocks of a token that are sorted in one task; those of a token with more are counted.
SORTED_BLOCKS = 16_384
CHUNK_BYTES = 1_000_000
SORT_BYTES = 2_000_000
_PLACE_BITS = np.uint64(21)
_INVERSE = np.uint64(pow(int(tokens._BASE), -1, 1 << 64))
_VALUES = tokens._RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _inverse_powers(n: int) -> np.ndarray:
    steps = np.full(n, _INVERSE, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _segments(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, place in the text, offsets, bytes): long texts in pieces that overlap by all strings' length."""
    for rows, at, data in tokens.chunks(column, CHUNK_BYTES):
        if len(data) <= CHUNK_BYTES + CHUNK_BYTES // 2:
            yield np.arange(rows.start, rows.stop), np.zeros(len(rows), dtype=np.int64), at, data
            continue
        for begin in range(0, len(data), CHUNK_BYTES):
            part = data[begin:begin + CHUNK_BYTES + length - 1]
            if len(part) >= length or not begin:
                yield np.array([rows.start]), np.array([begin]), np.array([0, len(part)]), part


def _blocks(at: np.ndarray, data: np.ndarray, length: int, token: int) -> tuple[np.ndarray, ...]:
    """(text, first string, strings, anchor's place in the first, token's hash, block's hash) of a chunk's blocks."""
    n, window = len(data), length - token + 1
    if n < length:
        return (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=np.uint64),) * 2
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * tokens.powers(n + 1)[:n], dtype=np.uint64, out=sums[1:])
    back = _inverse_powers(n + 1)
    grams = tokens.mix((sums[token:] - sums[:-token]) * back[:n - token + 1])
    # The smallest hash of each window, the leftmost of equal ones: the place stands in the lowest bits.
    low = np.uint64((1 << int(_PLACE_BITS)) - 1)
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(ranked) // window) + 1
    table = np.full(rows * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    table[:len(ranked)] = ranked
    table = table.reshape(rows, window)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = n - length + 1
    anchor = (np.minimum(behind[:strings], ahead[window - 1:window - 1 + strings]) & low).astype(np.int64)
    sizes = np.diff(at)
    valid = np.zeros(strings, dtype=bool)
    text = np.repeat(np.arange(len(sizes)), sizes)[:strings]
    valid[:] = np.arange(strings) + length <= at[text + 1]
    places = np.flatnonzero(valid)
    if not len(places):
        return (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=np.uint64),) * 2
    new = np.ones(len(places), dtype=bool)
    new[1:] = (np.diff(anchor[places]) != 0) | (np.diff(text[places]) != 0)
    first = places[new]
    count = np.diff(np.append(np.flatnonzero(new), len(places)))
    place = anchor[first] - first
    end = first + count - 1 + length
    body = (sums[end] - sums[first]) * back[first]
    name = tokens.mix(body + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + count.astype(np.uint64))
    return text[first], first - at[text[first]], count, place, grams[anchor[first]], name


def _repeated(data: np.ndarray, begin: np.ndarray, count: np.ndarray, place: np.ndarray, key: np.ndarray,
              length: int) -> np.ndarray:
    """Which strings of the blocks occur more than once: multikey quicksort, all parts of a depth at once.

    Equal strings have the same anchor place, which is the first key; then
    words of eight bytes follow, from both ends towards the anchor, where
    strings of one token differ most likely.
    """
    total = int(count.sum())
    block = np.repeat(np.arange(len(count)), count)
    inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    start = begin[block] + inside
    first_key = key[block].astype(np.int64) * (length + 1) + (place[block] - inside + 0)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    order = np.argsort(first_key, kind="stable")
    alive, part = _split(order, first_key[order])
    steps = list(range(0, length - 7, 8))
    if steps[-1] != length - 8:
        steps.append(length - 8)
    steps = [s for pair in zip(steps, reversed(steps)) for s in pair][:len(steps)]
    for step in steps:
        if not len(alive):
            break
        word = words[start[alive] + step]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(part) != 0]))
        mixed = np.minimum.reduceat(word, heads) != np.maximum.reduceat(word, heads)
        if not mixed.any():
            continue
        sizes = np.diff(np.append(heads, len(alive)))
        which = np.repeat(mixed, sizes)
        some = np.flatnonzero(which)
        resorted = some[np.lexsort((word[some], part[some]))]
        at = np.arange(len(alive))
        at[some] = resorted
        alive, part, word = alive[at], part[at], word[at]
        alive, part = _split(alive, part, word)
    out = np.zeros(total, dtype=bool)
    out[alive] = True
    return out


def _split(rows: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows cut where a key changes; parts of one row are done."""
    if not len(rows):
        return rows, rows
    change = np.zeros(len(rows), dtype=bool)
    change[0] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    part = np.cumsum(change) - 1
    keep = np.bincount(part)[part] > 1
    return rows[keep], part[keep]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _find_blocks(docs: DataFrame, length: int, token: int) -> DataFrame:
    schema = "text_key binary, first long, strings long, place long, token long, block long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, base, at, data in _segments(batch.column("body"), length):
                text, first, count, place, gram, name = _blocks(at, data, length, token)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_key").take(pa.array(rows[text])), pa.array(first + base[text]), pa.array(count),
                     pa.array(place), pa.array(gram.view(np.int64)), pa.array(name.view(np.int64))],
                    ["text_key", "first", "strings", "place", "token", "block"])

    return docs.select("text_key", "body").mapInArrow(work, schema)


def _sorted_buckets(length: int):
    """Blocks of sorted keys in, for each block the runs of its strings that occur in another block too."""
    names = ["token", "block", "from", "to"]

    def settle_part(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        sizes = np.array([len(r[3]) for r in rows])
        keys = {}
        key = np.array([keys.setdefault(r[0], len(keys)) for r in rows])
        count = sizes - length + 1
        place = np.array([r[2] for r in rows])
        flags = _repeated(data, np.cumsum(sizes) - sizes, count, place, key, length)
        out = []
        for row, part in zip(rows, np.split(flags, np.cumsum(count)[:-1])):
            out.extend((row[0], row[1], a, b) for a, b in _runs(part))
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("token", "block", "place", "bytes"))):
                if row[0] != last and size >= SORT_BYTES:
                    yield settle_part(rows)
                    rows, size = [], 0
                last = row[0]
                rows.append(row)
                size += len(row[3])
        if rows:
            yield settle_part(rows)

    return work


def _strike(length: int, schema):
    """Texts with the strings that repeat, in; what is left of them, out."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, left = [], [], []
            for body, runs in zip(batch.column("body"), batch.column("runs").to_pylist()):
                raw = memoryview(body.as_buffer())
                cut = []
                for begin, end in sorted((r["from"], r["to"] - 1 + length) for r in runs or ()):
                    if cut and begin <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], end)
                    else:
                        cut.append([begin, end])
                digest, at = hashlib.sha256(), 0
                for begin, end in cut:
                    digest.update(raw[at:begin])
                    at = end
                digest.update(raw[at:])
                removed.append(sum(b - a for a, b in cut))
                spans.append(len(cut))
                left.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(left, pa.string())], schema.names)
    return work


def _body(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def _with_bytes(distinct: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(token, block, place, strings, bytes): each block once, with its text."""
    wanted = distinct.select("token", "block", "at.*")
    part = F.substring(F.col("body"), (F.col("first") + 1).cast("int"), (F.col("strings") + length - 1).cast("int"))
    shown = texts.select("key", "body").join(wanted, F.col("key") == F.col("text_key"))
    # Several rows may have the block's text.
    return (shown.select("token", "block", "place", "strings", part.alias("bytes"))
            .groupBy("token", "block", "place", "strings").agg(F.first("bytes").alias("bytes")))


def _counted_strings(blocks: DataFrame, length: int) -> DataFrame:
    """(token, block, from, to): the strings of blocks that are in another block of their token too, by counting names.

    Counts are combined before the shuffle.  A block holds no string twice, as
    its strings have their anchor at different places.
    """
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("strings") - 1))
    named = settle(blocks.withColumn("from", at).select(
        "token", "block", "from", F.unhex(F.sha2(F.substring(
            F.col("bytes"), (F.col("from") + 1).cast("int"), F.lit(length)), 256)).alias("name")), "named")
    again = (named.groupBy("token", "name").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
             .select(F.col("token").alias("_token"), F.col("name").alias("_name")))
    return (named.join(again, (F.col("token") == F.col("_token")) & (F.col("name") == F.col("_name")), "left_semi")
            .select("token", "block", "from", (F.col("from") + 1).alias("to")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   token: int = TOKEN, sorted_blocks: int = SORTED_BLOCKS) -> DataFrame:
    """Strike out every byte that a string of ``length`` bytes covers which also starts elsewhere.

    Returns, for each row, ``id_col``, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 (of the remaining bytes).  All strings are
    judged on the input; matches never cross rows, and may overlap.  Null texts
    are empty; texts shorter than ``length`` lose nothing; rows of equal text
    repeat each other, also those of one id.  Other columns are not looked at;
    an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), _body(text_col).alias("body"))
    keyed = base.withColumn("text_key", F.unhex(F.md5("body")))
    found = _find_blocks(keyed.filter(F.octet_length("body") >= length), length, token)
    # Written, so that the join below deals out both sides anew and may split a frequent token.
    often = settle(found.groupBy("token").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
                   .select(F.col("token").alias("often")), "often")
    # Rows of equal text have the same blocks; from here on they count as two at most.  Dealing them out by text keeps
    # a frequent token from staying in the task that has joined it.
    blocks = settle(found.join(often, F.col("token") == F.col("often"), "left_semi").repartition("text_key")
                    .groupBy("text_key", "first", "strings", "place", "token", "block")
                    .agg(F.count(F.lit(1)).alias("rows")), "blocks")
    distinct = settle(blocks.groupBy("token", "block").agg(
        F.sum("rows").alias("times"), F.min(F.struct("text_key", "first", "strings", "place")).alias("at")), "distinct")
    kinds = settle(distinct.groupBy("token").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
    texts = keyed.select(F.col("text_key").alias("key"), "body", "id")
    few = kinds.filter(F.col("kinds") <= sorted_blocks)
    bucketed = (_with_bytes(distinct.join(few, "token", "left_semi"), texts, length)
                .repartitionByRange("token").sortWithinPartitions("token"))
    matched = bucketed.mapInArrow(_sorted_buckets(length), "token long, block long, from long, to long")
    many = kinds.filter(F.col("kinds") > sorted_blocks)
    if not many.isEmpty():
        matched = matched.unionAll(_counted_strings(
            _with_bytes(distinct.join(many, "token", "left_semi"), texts, length), length))
    whole = distinct.filter("times > 1").select("token", "block", F.lit(0).cast("long").alias("from"),
                                                F.col("at.strings").alias("to"))
    runs = settle(matched.unionAll(whole), "runs")
    spans = (blocks.select("text_key", "first", "token", "block").join(runs, ["token", "block"])
             .select("text_key", (F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to")).alias("to"))
             .groupBy("text_key").agg(F.collect_list(F.struct("from", "to")).alias("runs")))
    joined = texts.join(spans, F.col("key") == F.col("text_key"), "left").select(
        "id", "body", F.octet_length("body").cast("long").alias("n_bytes"), "runs")
    schema = joined.select("id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                           F.lit(0).cast("long").alias("n_spans"), F.lit("").alias("kept_sha256")).schema
    return joined.mapInArrow(_strike(length, schema), schema).withColumnRenamed("id", id_col)
