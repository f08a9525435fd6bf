"""Packing of documents into sequences as a cutting-stock problem.

A document's tokens are cut into whole sequences and a rest.  The lengths of
the rests form a histogram of at most 256 sizes.  A linear program over cutting
patterns finds how often each pattern is used; its columns are generated by a
knapsack over the dual prices.  Patterns are rounded down, what is left over is
packed greedily, and the documents of a size, ranked by a hash, take the
places that the patterns give to that size.  Only the histogram and the
patterns pass through the driver, and both have a fixed bound.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wavemeld.llm import tokens
from wavemeld.llm.common import rank_in_groups, settle

SEQUENCE = 2048
END_ID = 1
#: Lengths are rounded up to this many tokens in the linear program.
UNIT = 8
UNITS = SEQUENCE // UNIT
#: Columns generated at most; the rounding packs everything from whatever columns there are.
COLUMNS = 2000
#: Text that is encoded at once: a task holds some 50 bytes of arrays for each of its bytes.
CHUNK_BYTES = 1_000_000
# The special token of the vocabulary, and the white space that
# Unicode knows beyond ASCII, in UTF-8.
SPECIAL = "<|endoftext|>", 50256
WIDE_SPACE = [s.encode() for s in "\x85\xa0            "
              "    　"]


class Encoder:
    """Byte-pair ids of whole texts, with each distinct word of a chunk encoded once.

    The vocabulary's pattern never lets a token reach over the start of a run
    of white space, so a text's ids are those of its words, each with the white
    space before it.  Texts with white space beyond ASCII are encoded whole.
    """

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import tiktoken
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks,
                                     special_tokens={SPECIAL[0]: SPECIAL[1]})
        self.size = np.zeros(SPECIAL[1] + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)
        self.size[SPECIAL[1]] = len(SPECIAL[0])

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.bpe.encode(text.decode("utf-8", "replace"), allowed_special="all"), dtype=np.int64)

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of each text; a null text is empty."""
        for rows, at, data in tokens.chunks(column, CHUNK_BYTES):
            yield from zip(rows, self._chunk(at, data))

    def _chunk(self, at: np.ndarray, data: np.ndarray) -> Iterator[np.ndarray]:
        raw = data.tobytes()
        space = tokens._SPACE[data]
        # A word with its white space begins where white space follows something else, and where a text begins.
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        filled = np.flatnonzero(np.diff(at) > 0)
        begins[at[filled]] = True
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, at)
        if len(starts):
            place = np.arange(len(data)) - np.repeat(starts, ends - starts)
            values = tokens._VALUE.copy()
            values[[9, 10, 11, 12, 13, 32]] = np.uint64(3) + np.arange(6, dtype=np.uint64) * np.uint64(0x51F9A3B7C2D5E811)
            sums = np.add.reduceat(values[data] * tokens.powers(int((ends - starts).max()))[place], starts)
            hashes = tokens.mix(sums + (ends - starts).astype(np.uint64))
            _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
            flat, bounds = self._words([raw[starts[i]:ends[i]] for i in sample])
            sizes = np.diff(bounds)[which]
            ids = flat[np.repeat(bounds[:-1][which] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
                       + np.arange(int(sizes.sum()))]
            edges = np.concatenate([[0], np.cumsum(sizes)])[first]
        else:
            ids, edges = np.zeros(0, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        odd = any(s in raw for s in WIDE_SPACE)
        for i in range(len(at) - 1):
            if odd and any(s in raw[at[i]:at[i + 1]] for s in WIDE_SPACE):
                yield self.whole(raw[at[i]:at[i + 1]])
            else:
                yield ids[edges[i]:edges[i + 1]]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, bounds): one call for all words that begin with white space and end with something else."""
        blank = [not w.strip(b" \t\n\x0b\x0c\r") for w in words]
        bare = [not b and w[0] not in b" \t\n\x0b\x0c\r" for w, b in zip(words, blank)]
        # A word without white space before it gets a line feed, which is an id of its own.
        joined = b"".join(b"" if e else (b"\n" + w if b else w) for w, e, b in zip(words, blank, bare))
        ids = self.whole(joined)
        ends = np.cumsum(self.size[ids])
        widths = np.array([0 if e else len(w) + b for w, e, b in zip(words, blank, bare)], dtype=np.int64)
        last = np.searchsorted(ends, np.cumsum(widths), side="left") + 1
        last[np.cumsum(widths) == 0] = 0
        begin = np.concatenate([[0], last[:-1]]) + np.array(bare, dtype=np.int64)
        sizes = np.where(blank, 0, last - begin)
        if not any(blank):
            keep = np.ones(len(ids), dtype=bool)
            keep[begin[np.array(bare)] - 1] = False
            return ids[keep], np.concatenate([[0], np.cumsum(sizes)])
        parts = [self.whole(w) if e else ids[b:b + n] for w, e, b, n in zip(words, blank, begin, sizes)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _knapsack(prices: np.ndarray) -> tuple[float, dict[int, int]]:
    """The pattern of highest price; prices by size, 0 for sizes that are not there."""
    best = np.zeros(UNITS + 1)
    taken = np.zeros(UNITS + 1, dtype=int)
    for room in range(1, UNITS + 1):
        worth = prices[1:room + 1] + best[room - 1::-1][:room]
        size = int(worth.argmax())
        if worth[size] > best[room - 1] + 1e-12:
            best[room], taken[room] = worth[size], size + 1
        else:
            best[room] = best[room - 1]
    pattern: dict[int, int] = {}
    room = UNITS
    while room > 0:
        if taken[room]:
            pattern[int(taken[room])] = pattern.get(int(taken[room]), 0) + 1
            room -= int(taken[room])
        else:
            room -= 1
    return float(best[UNITS]), pattern


def _solve(demand: dict[int, int], columns: int) -> list[tuple[float, dict[int, int]]]:
    """Patterns and how often the linear program uses them: the simplex method with generated columns."""
    sizes = sorted(demand)
    row = {u: i for i, u in enumerate(sizes)}
    # To begin with, sizes that fill a sequence together are paired, and what is over of either is alone.
    patterns: list[dict[int, int]] = [{u: UNITS // u} for u in sizes]
    inverse = np.diag([1.0 / (UNITS // u) for u in sizes])
    for u in sizes:
        other = UNITS - u
        if other > u and other in row:
            less, more = (u, other) if demand[u] < demand[other] else (other, u)
            patterns[row[less]] = {u: 1, other: 1}
            # The inverse of these two columns, [[1, 0], [1, m]].
            inverse[row[less], row[less]] = 1.0
            inverse[row[more], row[less]] = -1.0 / (UNITS // more)
    use = np.maximum(inverse @ np.array([demand[u] for u in sizes], dtype=float), 0)
    for _ in range(columns):
        duals = inverse.sum(axis=0)
        prices = np.zeros(UNITS + 1)
        prices[sizes] = np.maximum(duals, 0)
        worth, pattern = _knapsack(prices)
        pattern = {u: n for u, n in pattern.items() if u in row}
        if worth <= 1 + 1e-7 or not pattern:
            break
        column = sum(inverse[:, row[u]] * n for u, n in pattern.items())
        positive = column > 1e-9
        if not positive.any():
            break
        ratios = np.where(positive, use / np.where(positive, column, 1), np.inf)
        out = int(ratios.argmin())
        pivot = inverse[out] / column[out]
        step = ratios[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        use = np.maximum(use - step * column, 0)
        use[out] = step
        patterns[out] = pattern
    return list(zip(use, patterns))


def cutting_patterns(demand: dict[int, int], columns: int = COLUMNS) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: pieces}) that cover a demand {size in units: pieces} exactly."""
    left = {u: n for u, n in demand.items() if n > 0}
    if not left:
        return []
    out = []
    for use, pattern in sorted(_solve(left, columns), key=lambda x: (-x[0], sorted(x[1].items()))):
        times = min([int(use + 1e-6), *(left[u] // n for u, n in pattern.items())])
        if times > 0:
            out.append((times, pattern))
            for u, n in pattern.items():
                left[u] -= times * n
    while left := {u: n for u, n in left.items() if n > 0}:
        room, pattern = UNITS, {}
        for u in sorted(left, reverse=True):
            if n := min(left[u], room // u):
                pattern[u] = n
                room -= n * u
        times = min(left[u] // n for u, n in pattern.items())
        out.append((times, pattern))
        for u, n in pattern.items():
            left[u] -= times * n
    return out


def _pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    zero = F.lit(0).cast("long")
    schema = narrow.select("id", zero.alias("start"), zero.alias("length"), zero.alias("crc"),
                           zero.alias("doc_tokens")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            at, start, length, crc, total = [], [], [], [], []
            for row, ids in encoder.texts(batch.column("text")):
                ids = np.append(ids, END_ID).astype("<u4")
                for begin in range(0, len(ids), SEQUENCE):
                    part = ids[begin:begin + SEQUENCE]
                    at.append(row)
                    start.append(begin)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64()))]
                + [pa.array(x, pa.int64()) for x in (start, length, crc, total)], schema.names)

    return narrow.mapInArrow(work, schema)


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   columns: int = COLUMNS) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids.

    A document is its text's ids (``vocabulary`` names a file of byte-pair
    ranks, ``pattern`` is its split) and id 1.  Returns, for each piece,
    ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Documents are cut at multiples of 2048 ids only.  A null or empty text is
    the one id 1.  Repeated rows are documents of their own; a null id is
    allowed.  Other columns are not looked at; an empty table gives no rows.
    """
    pieces = settle(_pieces(docs, id_col, text_col, vocabulary, pattern)
                    .withColumn("units", F.ceil(F.col("length") / F.lit(UNIT)).cast("int"))
                    .withColumn("draw", F.xxhash64("id", "start", "crc")), "pieces")
    demand = {r["units"]: r["n"] for r in pieces.groupBy("units").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, taken, sequences = [], dict.fromkeys(demand, 0), 0
    for times, cut in cutting_patterns(demand, columns):
        for units, n in cut.items():
            places.append((units, taken[units], taken[units] + times * n, n, sequences))
            taken[units] += times * n
        sequences += times
    spark = docs.sparkSession
    # A row for each size and pattern: some thousands at most, whatever the input.
    spots = spark.createDataFrame(places, "size int, low long, high long, each long, base long")
    ranked = rank_in_groups(pieces, ["units"], "draw", ["id", "start", "crc"], "rank",
                            max(1, max(demand.values(), default=1)))
    placed = (ranked.join(F.broadcast(spots), (F.col("units") == F.col("size")) & (F.col("rank") >= F.col("low"))
                          & (F.col("rank") < F.col("high")))
              .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
        F.col("sequence_id").cast("long").alias("sequence_id"),
        (F.sum("length").over(inside) - F.col("length")).cast("long").alias("offset"))
