"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

Every window of a document that has as many words as an item, or the whole of
a shorter document, gets a 64-bit SimHash of its word shingles.  Fingerprints are cut into eight blocks; two that
differ in at most 23 bits agree in some block up to two bits, so looking up
each block with up to two bits flipped misses no pair within that radius.
Candidates are verified by the weighted Jaccard similarity of their shingle
bags, where a shingle that few items have weighs more.

A window whose shingles cannot reach the similarity, since too little of their
weight occurs in any item, gets no fingerprint: that bound loses no match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wavemeld.llm import tokens

SIMILARITY = 0.75
RADIUS = 23
BLOCKS = 8
#: Text of items that is sent to the tasks at once; a larger benchmark is searched in several blocks.
ITEM_BYTES = 8_000_000
#: Windows that are fingerprinted at once.
WINDOWS = 4096

_BITS = np.arange(64, dtype=np.uint64)
#: For each byte, the bytes that differ from it in two bits at most.
_NEAR_BYTES = [np.flatnonzero(np.bitwise_count(np.arange(256) ^ b) <= RADIUS // BLOCKS) for b in range(256)]


def _signs(grams: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each shingle."""
    return ((grams[:, None] >> _BITS) & np.uint64(1)).astype(np.int8).astype(np.float32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


@dataclass
class _Length:
    """Items of one number of words."""

    words: int
    arity: int
    items: np.ndarray
    bags: list[tuple[np.ndarray, np.ndarray]]
    totals: np.ndarray
    prints: np.ndarray
    near: np.ndarray


@dataclass
class Weights:
    """Weights of shingles over the whole benchmark.

    Only shingles that several items have are listed: one that a single item
    has weighs as much as one that none has.
    """

    items: int
    grams: dict[int, np.ndarray]
    times: dict[int, np.ndarray]

    def of(self, arity: int, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), np.log1p(max(1, self.items)))
        known = self.grams.get(arity)
        if known is not None:
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            hit = known[at] == grams
            out[hit] = np.log1p(self.items / self.times[arity][at[hit]])
        return out


class Items:
    """A block of the items of a benchmark, ready to be looked for."""

    def __init__(self, ids: list, texts: list[str | None], weights: Weights, similarity: float = SIMILARITY) -> None:
        self.ids, self.weights, self.similarity = ids, weights, similarity
        self.grams: dict[int, np.ndarray] = {}
        found = list(_item_grams(pa.array(texts, pa.string())))
        for arity in {a for _, _, a, _ in found}:
            self.grams[arity] = np.unique(np.concatenate([g for _, _, a, g in found if a == arity]))
        self.lengths = [self._length(n, [x for x in found if x[1] == n]) for n in sorted({x[1] for x in found})]

    def __getstate__(self) -> dict:
        # The weights are sent once for all blocks.
        return self.__dict__ | {"weights": None}

    def weigh(self, arity: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight, occurs in an item of the block) of each shingle."""
        known = self.grams[arity]
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return self.weights.of(arity, grams), known[at] == grams

    def _length(self, n: int, found: list) -> _Length:
        arity, bags, totals, prints = found[0][2], [], [], []
        for _, _, _, grams in found:
            weight, _ = self.weigh(arity, grams)
            bags.append(np.unique(grams, return_counts=True))
            totals.append(weight.sum())
            prints.append(_pack((_signs(grams) * weight[:, None]).sum(axis=0)[None, :])[0])
        prints = np.array(prints, dtype=np.uint64)
        # near[block, byte]: the items whose byte in that block is that one up to two bits.
        near = np.zeros((BLOCKS, 256, len(prints)), dtype=bool)
        for block in range(BLOCKS):
            own = ((prints >> np.uint64(8 * block)) & np.uint64(255)).astype(int)
            for b in range(256):
                near[block, b] = np.isin(own, _NEAR_BYTES[b])
        return _Length(n, arity, np.array([row for row, *_ in found]), bags, np.array(totals), prints, near)

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, item, similarity, first word, distance): the best window of each text and item."""
        for chunk in tokens.words(column):
            hashes = chunk.hashes()
            for arity, known in self.grams.items():
                grams, counts = tokens.shingles(hashes, chunk.first, arity) if arity > 1 else (
                    _grams(hashes, 1), np.diff(chunk.first))
                # The lowest bits first: most shingles occur in no item.
                low = np.zeros(1 << 16, dtype=bool)
                low[(known & np.uint64(0xFFFF)).astype(int)] = True
                maybe = np.flatnonzero(low[(grams & np.uint64(0xFFFF)).astype(int)])
                hits = maybe[np.isin(grams[maybe], known)]
                for text in np.unique(np.searchsorted(chunk.first, hits, side="right") - 1):
                    begin = int(chunk.first[text])
                    own = grams[begin:begin + int(counts[text])]
                    for item, found in self._text(arity, own).items():
                        yield chunk.rows[int(text)], item, *found

    def _text(self, arity: int, grams: np.ndarray) -> dict[int, tuple[float, int, int]]:
        weight, hit = self.weigh(arity, grams)
        reach = np.concatenate([[0.0], np.cumsum(weight * hit)])
        mass = np.concatenate([[0.0], np.cumsum(weight)])
        best: dict[int, tuple[float, int, int]] = {}
        for length in self.lengths:
            if length.arity != arity:
                continue
            # A text with fewer shingles than the item is one window.
            size = min(length.words - length.arity + 1, len(grams))
            # A window shares with an item no more weight than its shingles that occur in items have.
            shared, whole = reach[size:] - reach[:-size], mass[size:] - mass[:-size]
            able = np.flatnonzero(shared >= self.similarity * np.maximum(whole, length.totals.min()) - 1e-9)
            for part in np.split(able, range(WINDOWS, len(able), WINDOWS)):
                if len(part):
                    self._windows(length, grams, weight, part, size, best)
        return best

    def _windows(self, length: _Length, grams: np.ndarray, weight: np.ndarray, starts: np.ndarray, size: int,
                 best: dict[int, tuple[float, int, int]]) -> None:
        prints = self._prints(grams, weight, starts, size)
        candidates = np.zeros((len(starts), len(length.prints)), dtype=bool)
        for block in range(BLOCKS):
            candidates |= length.near[block, ((prints >> np.uint64(8 * block)) & np.uint64(255)).astype(int)]
        own, place = np.nonzero(candidates)
        distance = np.bitwise_count(prints[own] ^ length.prints[place])
        for o, p, far in zip(own, place, distance):
            if far <= RADIUS:
                start, item = int(starts[o]), int(length.items[p])
                alike = self._similarity(length, p, grams[start:start + size], weight[start:start + size])
                if alike >= self.similarity and (item not in best or (-alike, start) < (-best[item][0], best[item][1])):
                    best[item] = (float(alike), start, int(far))

    def _prints(self, grams: np.ndarray, weight: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of windows, from running sums over the stretch that holds them."""
        out = np.zeros(len(starts), dtype=np.uint64)
        for run in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > size) + 1):
            low, high = int(starts[run[0]]), int(starts[run[-1]]) + size
            signed = _signs(grams[low:high]).astype(np.float64) * weight[low:high, None]
            sums = np.concatenate([np.zeros((1, 64)), np.cumsum(signed, axis=0)])
            at = starts[run] - low
            out[run] = _pack(np.round(sums[at + size] - sums[at], 9))
        return out

    def _similarity(self, length: _Length, place: int, grams: np.ndarray, weight: np.ndarray) -> float:
        theirs, times = length.bags[place]
        mine, first, own_times = np.unique(grams, return_index=True, return_counts=True)
        both, a, b = np.intersect1d(mine, theirs, assume_unique=True, return_indices=True)
        shared = (np.minimum(own_times[a], times[b]) * weight[first[a]]).sum()
        return shared / (weight.sum() + length.totals[place] - shared)


def _grams(word_hashes: np.ndarray, arity: int) -> np.ndarray:
    grams, _ = tokens.shingles(word_hashes, np.array([0, len(word_hashes)]), arity)
    return grams[:max(0, len(word_hashes) - arity + 1)]


def _item_grams(texts: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, words, arity, shingles) of each text that has a word."""
    for chunk in tokens.words(texts):
        hashes = chunk.hashes()
        for row, begin, end in zip(chunk.rows, chunk.first[:-1], chunk.first[1:]):
            if end > begin:
                arity = min(tokens.SHINGLE_WORDS, int(end - begin))
                yield row, int(end - begin), arity, _grams(hashes[begin:end], arity)


def _benchmark(benchmark: DataFrame, id_col: str, text_col: str, similarity: float,
               item_bytes: int) -> tuple[Weights, Iterator[Items]]:
    """(weights over the whole benchmark, the items in blocks of a bounded size, one at a time)."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    count, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, arity, grams in _item_grams(batch.column("text")):
                own = np.unique(grams)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), arity)), pa.array(own.view(np.int64))], ["arity", "gram"])

    several = (items.select("text").mapInArrow(shingles, "arity long, gram long").groupBy("arity", "gram")
               .agg(F.count(F.lit(1)).alias("times")).filter("times > 1").toArrow())
    arity, times = several.column("arity").to_numpy(), several.column("times").to_numpy()
    grams = several.column("gram").to_numpy().view(np.uint64)
    weights = Weights(count, {}, {})
    for a in np.unique(arity):
        order = np.flatnonzero(arity == a)
        order = order[np.argsort(grams[order])]
        weights.grams[int(a)], weights.times[int(a)] = grams[order], times[order]
    n = max(1, -(-int(size or 0) // max(1, item_bytes)))

    def blocks() -> Iterator[Items]:
        for block in range(n):
            rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).orderBy("id", "text").collect()
            if rows:
                yield Items([r["id"] for r in rows], [r["text"] for r in rows], weights, similarity)

    return weights, blocks()


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
                  item_bytes: int = ITEM_BYTES) -> DataFrame:
    """A row for each document and item of which some item-sized window is similar enough.

    A document shorter than the item is one window.

    Returns ``id_col``, item_id, similarity (rounded to 6), first_word (of the
    best window, the first of equal ones), n_words (of the item), distance (of
    the fingerprints).  Shingles have five words, those of a shorter item all
    its words.  Null or empty texts and items match nothing; a repeated
    document or item gives its rows again.  Other columns are not looked at.
    A benchmark of over ``item_bytes`` of text is searched in blocks of about
    that size; shingles are weighed over the whole benchmark.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = benchmark.select(F.col(item_id_col).alias("item"))
    schema = narrow.select("id", F.lit(0).alias("place"), F.lit(0.0).alias("similarity"),
                           F.lit(0).alias("first_word"), F.lit(0).alias("n_words"), F.lit(0).alias("distance")).schema
    spark, parts = docs.sparkSession, []
    weights, blocks = _benchmark(benchmark, item_id_col, item_text_col, similarity, item_bytes)
    heavy = spark.sparkContext.broadcast(weights)
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        found = narrow.mapInArrow(_finder(shared, heavy, schema), schema)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"at int, item_id {ids.schema[0].dataType.simpleString()}")
        parts.append(found.join(F.broadcast(names), F.col("place") == F.col("at")))
    if not parts:
        nothing = narrow.filter(F.lit(False)).withColumn("item_id", F.lit(None).cast(ids.schema[0].dataType))
        parts = [nothing.select("id", "item_id", F.lit(0.0).alias("similarity"), F.lit(0).alias("first_word"),
                                F.lit(0).alias("n_words"), F.lit(0).alias("distance"))]
    return reduce(DataFrame.unionByName, [p.select(
        F.col("id").alias(id_col), "item_id", F.round("similarity", 6).alias("similarity"),
        F.col("first_word").cast("long").alias("first_word"), F.col("n_words").cast("long").alias("n_words"),
        F.col("distance").cast("long").alias("distance")) for p in parts])


def _finder(shared, heavy, schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        items.weights = heavy.value
        n_words = {int(i): length.words for length in items.lengths for i in length.items}
        for batch in batches:
            rows = list(items.search(batch.column("text")))
            at, place, alike, first, distance = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), pa.array(place, pa.int32()),
                 pa.array(alike, pa.float64()), pa.array(first, pa.int32()),
                 pa.array([n_words[p] for p in place], pa.int32()), pa.array(distance, pa.int32())], schema.names)
    return work


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", similarity: float = SIMILARITY,
                      item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    context = docs.sparkSession.sparkContext
    weights, blocks = _benchmark(benchmark, item_id_col, item_text_col, similarity, item_bytes)
    heavy = context.broadcast(weights)
    for block in blocks:
        docs = docs.mapInArrow(_clean(context.broadcast(block), heavy, docs.columns.index(text_col)), docs.schema)
    return docs


def _clean(shared, heavy, place: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        items.weights = heavy.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[row for row, *_ in items.search(batch.column(place))]] = False
            yield batch.filter(pa.array(keep))
    return work
