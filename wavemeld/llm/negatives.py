"""Hard negatives by exact inner-product search with coordinate pruning.

Vectors are put in order of label and length and cut into blocks.  In a block
they lie in length buckets, each with a sorted list of the values of every
coordinate.  An anchor that needs a score of at least s meets a bucket of
vectors of length L at most only if |q|·L >= s, and then only vectors at an
angle of cosine t = s / (|q|·L) or more.  For such a vector the value of each
coordinate lies in a range that follows from t and the anchor's value there; the
ranges of the anchor's focus coordinates (its largest ones) are looked up in the
sorted lists, the vectors of the narrowest range are intersected with the others,
and only what is left is verified by its exact integer score.  The bound s rises
as better vectors are found.  Where the ranges hardly narrow a bucket, all of it
is verified by one matrix product.

A query runs in two searches: the best vectors of an anchor's own label, then
for each of these the best vectors of other labels within the range of scores
that it allows.  Anchors are cut into blocks as well, and a task holds one block
of each kind, whatever the label has; vectors too short for every anchor of a
block are not sent to it.

Rows: those without an id or label, without a vector, or with a component that
is null or not finite take no part.  Rows are told apart by themselves and not
by their ids: a repeated row is one more vector, and one more anchor.  A vector
that is shorter than others has zeros at its end; an empty one scores 0 with
all.  Scores beyond a long are held at its ends.  Other columns are not read.
Ties go to the smaller id.  An empty table has no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from wavemeld.llm.common import settle

POSITIVES = 5
NEGATIVES = 5
SCALE = 256
#: A negative scores at least this many hundredths of its positive, and at most as much.
LEAST_PERCENT = 80
#: Vectors in a block, anchors in a block, vectors in a length bucket.
BLOCK_ROWS = 32_768
ANCHOR_ROWS = 16_384
BUCKET_ROWS = 1024
#: Anchors that are searched for at a time.
AT_ONCE = 256
FOCUS = 4
#: With more than this share of a bucket left by the narrowest range, all of it is verified.
DENSE = 0.1
#: Relative slack of the bounds, far above rounding errors.
SLACK = 1e-9
EXACT = float(1 << 53)
SMALL = 1 << 15
LONG = (1 << 63) - 1


def _quantised(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Components as integers: two bytes each, or as text in rows where one is too large for that."""
    for batch in batches:
        column = batch.column(3)
        at = column.offsets.to_numpy().astype(np.int64)
        flat = column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
        at -= at[0]
        whole = np.floor(np.clip(flat * scale, -2.0 * SMALL, 2.0 * SMALL))
        fits = (whole >= -SMALL) & (whole < SMALL)
        outside = np.concatenate([[0], np.cumsum(~fits)])
        small = outside[at[1:]] == outside[at[:-1]]
        squares = np.concatenate([[0], np.cumsum(np.where(fits, whole, 0).astype(np.int64) ** 2)])
        length = np.sqrt((squares[at[1:]] - squares[at[:-1]]).astype(np.float64))
        raw = np.where(fits, whole, 0).astype("<i2").tobytes()
        vectors = [raw[2 * a:2 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        for i in np.flatnonzero(~small).tolist():
            exact = [_floor(x, scale) for x in flat[at[i]:at[i + 1]].tolist()]
            vectors[i] = " ".join(map(str, exact)).encode()
            length[i] = min(math.hypot(*map(_float, exact)), 1e300)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(vectors, pa.binary()), pa.array(length), pa.array(small)],
            ["id", "label", "anchor", "vector", "length", "small"])


def _floor(x: float, scale: int) -> int:
    return math.floor(x * scale) if abs(x) < EXACT else int(x) * scale


def _float(x: int) -> float:
    return float(max(-10 ** 300, min(10 ** 300, x)))


@dataclass
class Block:
    """Some vectors as a matrix; ``large`` holds the integers of those that floats might not hold exactly."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    length: np.ndarray
    matrix: np.ndarray
    large: dict[int, list[int]]

    @staticmethod
    def of(table: pa.Table, width: int) -> "Block":
        vectors, small = table["vector"].to_pylist(), table["small"].to_pylist()
        matrix, large = np.zeros((len(vectors), width)), {}
        if all(small) and all(len(v) == 2 * width for v in vectors):
            matrix = np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), width).astype(np.float64)
        else:
            for i, (v, short) in enumerate(zip(vectors, small)):
                if not short:
                    large[i] = [int(x) for x in v.split()]
                values = np.frombuffer(v, "<i2") if short else [_float(x) for x in large[i]]
                matrix[i, :len(values)] = values
        return Block(*[table[c].to_numpy() for c in ("row", "id", "label", "length")], matrix, large)

    def take(self, at: np.ndarray) -> "Block":
        large = {i: self.large[j] for i, j in enumerate(at.tolist()) if j in self.large} if self.large else {}
        return Block(self.row[at], self.id[at], self.label[at], self.length[at], self.matrix[at], large)

    def whole(self, i: int) -> list[int]:
        return self.large[i] if i in self.large else [int(x) for x in self.matrix[i]]


def width_of(table: pa.Table) -> int:
    """Components of the longest vector."""
    small, size = table["small"].to_numpy(), pc.binary_length(table["vector"]).to_numpy()
    wide = [len(v.split()) for v in table.filter(pc.invert(table["small"]))["vector"].to_pylist()]
    return max(int(size[small].max(initial=0)) // 2, max(wide, default=0))


def scores(a: Block, b: Block) -> np.ndarray:
    """Exact integer inner products of all of ``a`` with all of ``b``, held at the ends of a long."""
    out = a.matrix @ b.matrix.T
    most = [np.abs(x.matrix).max(axis=1, initial=0) if x.large else np.full(len(x.row), float(SMALL)) for x in (a, b)]
    if not a.large and not b.large:
        return out.astype(np.int64)
    rough = a.matrix.shape[1] * np.outer(*most) >= EXACT
    exact = np.where(rough, 0, out).astype(np.int64)
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(rough))):
        exact[i, j] = max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(a.whole(i), b.whole(j)))))
    return exact


@dataclass
class Bucket:
    """Vectors of similar length, with the sorted values of each coordinate and their order."""

    rows: Block
    longest: float
    unit: np.ndarray
    values: np.ndarray
    order: np.ndarray

    @staticmethod
    def of(rows: Block) -> "Bucket":
        unit = rows.matrix / np.where(rows.length > 0, rows.length, 1.0)[:, None]
        order = np.argsort(unit, axis=0, kind="stable")
        return Bucket(rows, float(rows.length.max(initial=0.0)), unit, np.take_along_axis(unit, order, 0), order)


def buckets(rows: Block) -> list[Bucket]:
    """The vectors in order of length, longest first."""
    order = np.lexsort((rows.row, -rows.length))
    return [Bucket.of(rows.take(order[i:i + BUCKET_ROWS])) for i in range(0, len(order), BUCKET_ROWS)]


@dataclass
class Search:
    """The best vectors of some anchors within ranges of scores.

    Anchor i has ``least[i, k] <= score <= most[i, k]`` for its k-th range; a
    range whose least is above its most is empty.
    """

    anchors: Block
    least: np.ndarray
    most: np.ndarray
    top: int
    same_label: bool

    def run(self, parts: list[Bucket]) -> tuple[np.ndarray, ...]:
        """(anchor, range, row, id, score) as arrays, ``top`` for each anchor and range at most."""
        n, k = self.least.shape
        self.open = self.least <= self.most
        self.need = np.where(self.open, self.least, LONG)
        best = [np.zeros(0, dtype=np.int64) for _ in range(5)]
        lengths = self.anchors.length
        unit = self.anchors.matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        for part in parts:
            floor = np.where(self.open, self.need, np.inf).min(axis=1)
            with np.errstate(over="ignore"):
                reach = lengths * part.longest * (1 + SLACK)
            alive = np.flatnonzero(self.open.any(axis=1) & (reach >= floor))
            if not len(alive):
                continue
            found = list(self._candidates(part, alive, floor, reach, unit, focus))
            if found:
                best = self._keep(best, part.rows, *map(np.concatenate, zip(*found)))
        return tuple(best)

    def _candidates(self, part: Bucket, alive, floor, reach, unit, focus) -> Iterator[tuple]:
        """(anchors, vectors, scores) that the coordinates allow, with their exact scores."""
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            t = np.where(floor[alive] > 0, floor[alive] / reach[alive], -1.0)
        t = np.clip(np.nan_to_num(t, nan=-1.0, posinf=1.0), -1.0, 1.0)
        size = len(part.rows.row)
        at = focus[alive]
        q = np.take_along_axis(unit[alive], at, 1)
        spread = np.sqrt(np.maximum(0.0, (1 - t * t)[:, None] * (1 - q * q)))
        low = np.where(-q >= t[:, None], -1.0, q * t[:, None] - spread) - SLACK
        high = np.where(q >= t[:, None], 1.0, q * t[:, None] + spread) + SLACK
        begin, end = np.zeros(at.shape, dtype=np.int64), np.full(at.shape, size)
        for f in np.unique(at):
            rows, cols = np.nonzero(at == f)
            begin[rows, cols] = np.searchsorted(part.values[:, f], low[rows, cols], side="left")
            end[rows, cols] = np.searchsorted(part.values[:, f], high[rows, cols], side="right")
        # Without a positive bound no coordinate says anything.
        begin[t <= 0], end[t <= 0] = 0, size
        left = (end - begin).min(axis=1) if at.shape[1] else np.full(len(alive), size)
        dense = alive[left > DENSE * size]
        for i in range(0, len(dense), AT_ONCE):
            some = dense[i:i + AT_ONCE]
            exact = scores(self.anchors.take(some), part.rows)
            which, cols = np.nonzero(exact >= self.need[some].min(axis=1)[:, None])
            yield some[which], cols, exact[which, cols]
        sparse = np.flatnonzero((left <= DENSE * size) & (left > 0))
        for i in sparse.tolist():
            first = int((end[i] - begin[i]).argmin())
            kept = part.order[begin[i, first]:end[i, first], at[i, first]]
            for j, f in enumerate(at[i].tolist()):
                if j != first and len(kept):
                    value = part.unit[kept, f]
                    kept = kept[(value >= low[i, j]) & (value <= high[i, j])]
            if len(kept):
                exact = scores(self.anchors.take(alive[i:i + 1]), part.rows.take(kept))[0]
                yield np.full(len(kept), alive[i]), kept, exact

    def _keep(self, best: list, rows: Block, which, cols, values) -> list:
        a = self.anchors
        same = a.label[which] == rows.label[cols]
        fit = (same == self.same_label) & (a.row[which] != rows.row[cols])
        which, cols, values = which[fit], cols[fit], values[fit]
        new = []
        for k in range(self.need.shape[1]):
            ok = self.open[which, k] & (values >= self.need[which, k]) & (values <= self.most[which, k])
            new.append((which[ok], np.full(int(ok.sum()), k), rows.row[cols[ok]], rows.id[cols[ok]], values[ok]))
        if not sum(len(x[0]) for x in new):
            return best
        best = [np.concatenate(x) for x in zip(best, *new)]
        # np.int64's least value has no negative; ~x is in the opposite order for every x.
        order = np.lexsort((best[2], best[3], ~best[4], best[1], best[0]))
        best = [x[order] for x in best]
        group = best[0] * self.need.shape[1] + best[1]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        kept = rank < self.top
        last = np.flatnonzero(rank == self.top - 1)
        self.need[best[0][last], best[1][last]] = np.maximum(self.need[best[0][last], best[1][last]], best[4][last])
        return [x[kept] for x in best]


FOUND = "anchor_row long, anchor_id long, slot long, row long, id long, score long"
FOUND_NAMES = ["anchor_row", "anchor_id", "slot", "row", "id", "score"]


def search_blocks(anchors: pa.Table, vectors: pa.Table, top: int, same_label: bool) -> pa.Table:
    """One block of anchors against one block of vectors.

    ``least`` and ``most`` of the anchors are lists, one entry for each range.
    """
    if not anchors.num_rows or not vectors.num_rows:
        return pa.table([pa.array([], pa.int64()) for _ in FOUND_NAMES], FOUND_NAMES)
    width = max(width_of(anchors), width_of(vectors))
    a, parts = Block.of(anchors, width), buckets(Block.of(vectors, width))
    least, most = _padded(anchors["least"].to_pylist(), LONG), _padded(anchors["most"].to_pylist(), -LONG)
    out = []
    for i in range(0, len(a.row), AT_ONCE):
        some = np.arange(i, min(i + AT_ONCE, len(a.row)))
        which, slot, row, ids, score = Search(a.take(some), least[some], most[some], top, same_label).run(parts)
        out.append([a.row[some][which], a.id[some][which], slot, row, ids, score])
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], FOUND_NAMES)


def _padded(lists: list[list[int]], filler: int) -> np.ndarray:
    ranges = max(map(len, lists))
    return np.array([x + [filler] * (ranges - len(x)) for x in lists], dtype=np.int64)


def quantise(vectors: DataFrame, anchors: Column, id: str = "vec_id", label: Column | str = "label",
             vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, label, anchor, vector, length, small): the rows that take part, components as floor(scale * x)."""
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    values = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    rows = (vectors.select(F.col(f"`{id}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                           F.coalesce(anchors, F.lit(False)).alias("anchor"), values.alias("vector"))
            .filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(~odd))
    return rows.mapInArrow(lambda batches: _quantised(batches, scale),
                           "id long, label long, anchor boolean, vector binary, length double, small boolean")


def index(quantised: DataFrame, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """All vectors in blocks of one order, by label and falling length, with the blocks of anchors (``part``).

    A label with many vectors has many blocks, and small labels share one.
    Successive blocks are one part until it has ``anchor_rows`` anchors.
    """
    rows = settle(quantised, "quantised")
    n = rows.count()
    ordered = rows.repartitionByRange(max(1, -(-n // block_rows)), "label", F.desc("length"), "id")
    blocks = settle(ordered.withColumn("block", F.spark_partition_id().cast("long"))
                    .withColumn("row", F.monotonically_increasing_id()), "vectors")
    # One row for each block: the number of blocks is that of the vectors by block_rows.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("block").agg(F.count_if("anchor").alias("anchors"))
             .select("block", F.floor(F.coalesce(F.sum("anchors").over(before), F.lit(0)) / anchor_rows).alias("part")))
    return settle(blocks.join(parts, "block"), "blocks")


def _pairs(vectors: DataFrame, anchors: DataFrame, same_label: bool) -> DataFrame:
    """(part, block, reach, floor): which blocks of anchors have to see which blocks of vectors.

    These are numbers of blocks only.  Blocks of no common label do not meet for
    positives, those of one and the same label not for negatives, and blocks
    whose longest vector is too short for every anchor of a part not at all.
    """
    bounds = settle(anchors.groupBy("part").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.max("length").alias("reach"),
        F.min(F.array_min("least")).cast("double").alias("floor")), "bounds")
    last = bounds.agg(F.max("part")).first()[0]
    blocks = (vectors.groupBy("block").agg(F.min("label").alias("least_label"), F.max("label").alias("most_label"),
                                           F.max("length").alias("longest")))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(last or 0).cast("bigint"))
    met = blocks.withColumn("part", F.explode(numbers)).join(bounds, "part")
    if same_label:
        met = met.filter((F.col("least_label") <= F.col("last")) & (F.col("most_label") >= F.col("first")))
    else:
        met = met.filter((F.col("least_label") != F.col("most_label")) | (F.col("first") != F.col("last")) |
                         (F.col("least_label") != F.col("first")))
    return met.filter(_within("longest")).select("part", "block", "reach", "floor")


def _within(length: str) -> Column:
    return F.col(length) * F.col("reach") * F.lit(1 + SLACK) >= F.col("floor")


def search(vectors: DataFrame, anchors: DataFrame, top: int, same_label: bool) -> DataFrame:
    """The ``top`` best vectors of each anchor and range, with their ``rank`` from 1 on.

    ``anchors`` are rows of :func:`index` with lists ``least`` and ``most``.
    """
    pairs = settle(_pairs(vectors, anchors, same_label), "pairs")
    sent = vectors.drop("part").join(pairs, "block").filter(_within("length")).select(
        "part", "block", "row", "id", "label", "vector", "length", "small")
    asked = anchors.drop("block").join(pairs.select("part", "block"), "part").select(
        "part", "block", "row", "id", "label", "vector", "length", "small", "least", "most")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_blocks(left, right, top, same_label)

    found = asked.groupBy("part", "block").cogroup(sent.groupBy("part", "block")).applyInArrow(work, FOUND)
    order = Window.partitionBy("anchor_row", "slot").orderBy(F.col("score").desc(), "id", "row")
    # The rank is cut to ``top`` in each task before the shuffle.
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.lit(top))


def _own_block(vectors: DataFrame, top: int) -> DataFrame:
    """(row, least): a score that ``top`` vectors of its own label and block reach, for anchors with so many."""
    free, open_end = pa.scalar([-LONG - 1], pa.list_(pa.int64())), pa.scalar([LONG], pa.list_(pa.int64()))

    def work(block: pa.Table) -> pa.Table:
        anchors = block.filter(block["anchor"])
        for name, value in (("least", free), ("most", open_end)):
            anchors = anchors.append_column(name, pa.array([value.as_py()] * anchors.num_rows, value.type))
        return search_blocks(anchors, block, top, True)

    found = vectors.groupBy("block").applyInArrow(work, FOUND)
    return (found.groupBy(F.col("anchor_row").alias("row")).agg(F.count(F.lit(1)).alias("found"),
                                                                  F.min("score").alias("least"))
            .filter(F.col("found") == top).select("row", "least"))


def mine_negatives(vectors: DataFrame, anchors: Column, id: str = "vec_id", label: Column | str = "label",
                   vector: str = "embedding", scale: int = SCALE, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, block_rows: int = BLOCK_ROWS,
                   anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row for which ``anchors`` holds and each of its first ``positives``
    rows of the same label: the first ``negatives`` rows of other labels that
    score at least ``least_percent`` hundredths of the positive, and no more
    than it.  ``label`` is a column or an expression over ``vectors``.
    """
    rows = index(quantise(vectors, anchors, id, label, vector, scale), block_rows, anchor_rows)
    asking = rows.filter("anchor").join(_own_block(rows, positives), "row", "left")
    lowest = F.coalesce("least", F.lit(-LONG - 1).cast("bigint"))
    asking = settle(asking.withColumn("least", F.array(lowest))
                    .withColumn("most", F.array(F.lit(LONG).cast("bigint"))), "anchors")
    good = settle(search(rows, asking, positives, True).select(
        "anchor_row", "anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # Decimals, since a long times a percentage may be no long.
    least = F.ceil(F.col("positive_score").cast("decimal(19,0)") * least_percent / 100).cast("bigint")
    ranges = F.sort_array(F.collect_list(F.struct("place", least.alias("least"), F.col("positive_score").alias("most"))))
    allowed = (good.groupBy(F.col("anchor_row").alias("row")).agg(ranges.alias("ranges"))
               .select("row", F.col("ranges.least").alias("least"), F.col("ranges.most").alias("most")))
    wanting = settle(asking.drop("least", "most").join(allowed, "row"), "ranges")
    bad = search(rows, wanting, negatives, False).select(
        "anchor_row", (F.col("slot") + 1).cast("int").alias("place"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return (bad.join(good, ["anchor_row", "place"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
