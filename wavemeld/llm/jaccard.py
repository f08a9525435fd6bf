"""Documents linked by the Jaccard similarity of their word shingles, and the groups that links make.

Every document is a set of hashed shingles; equal sets are one from then on.
Two sets that are similar enough share several shingles among the quarter of
each that comes first in one fixed order, so sets that share too few with any
other are done, and the others form clusters.  Where many sets have a shingle
of their first quarter, these are one cluster without counting pairs.  A
cluster is cut into leaves of similar size.  A signature tree stands over each leaf: its nodes hold the combined bitmaps and
the size range of the sets below.  Two trees are walked together, and a pair of
nodes is left when the largest overlap it allows is too small, or when all
below is linked already.  What remains is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.llm import tokens
from wavemeld.llm.common import components, fresh, same, settle

#: Similarity in hundredths.
PERCENT = 75
#: Rows looked at, at least, for shingles that very many texts have; these come last in the order, which any order allows.
SAMPLE_ROWS = 8000
COMMON = 3
#: Sets that share a shingle are paired up to this many; more are put into one cluster.
PAIRED = 256
LEAF = 512
FANOUT = 4
BITMAP_WORDS = 16
_WORD = "[^ \\t\\n\\x0B\\f\\r]"


def _shared_least(n):
    """How many shingles two similar sets share within their prefixes, if the smaller has ``n``."""
    return 1 + n // 25


def _shared_least_col(n: str) -> Column:
    return 1 + F.floor(F.col(n) / 25)


def _prefix(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles in the order, of which two similar sets share some.

    An overlap of three quarters of a set leaves room for a quarter of it
    before the first shared shingle; each place more holds a further shared one.
    """
    count = len(grams) - -(-PERCENT * len(grams) // 100) + _shared_least(len(grams))
    if len(common):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        late = common[at] == grams
        grams = np.concatenate([grams[~late], grams[late]])
    return grams[:count]


def _set_names(grams: np.ndarray) -> int:
    """A 64-bit name of a set."""
    place = np.arange(1, len(grams) + 1, dtype=np.uint64)
    total = tokens.mix(grams + place * np.uint64(0x9FB21C651E98DF25)).sum(dtype=np.uint64)
    return int(tokens.mix(np.array([total + np.uint64(len(grams))], dtype=np.uint64)).view(np.int64)[0])


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, text_hash, n, name) of every row; name is null for an empty set."""
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    schema = docs.select("id", "text_hash", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("name")).schema
    for field in schema.fields:
        field.nullable = True

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names = [0] * batch.num_rows, [None] * batch.num_rows
            for row, grams in tokens.shingle_sets(batch.column("text"), k):
                if len(grams):
                    sizes[row], names[row] = len(grams), _set_names(grams)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64())],
                schema.names)

    return docs.mapInArrow(work, schema)


def _keys(docs: DataFrame, k: int, common) -> DataFrame:
    """(gram, name, n) of every prefix."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, names, sizes = [], [], []
            size = 0
            for _, own in tokens.shingle_sets(batch.column("text"), k):
                if len(own):
                    part = _prefix(own, common.value)
                    grams.append(part)
                    names.append(np.full(len(part), _set_names(own)))
                    sizes.append(np.full(len(part), len(own)))
                    size += len(part)
                if size > 200_000:
                    yield _key_batch(grams, names, sizes)
                    grams, names, sizes, size = [], [], [], 0
            if grams:
                yield _key_batch(grams, names, sizes)

    return docs.select("text").mapInArrow(work, "gram long, name long, n long")


def _key_batch(grams: list, names: list, sizes: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(names)),
                                       pa.array(np.concatenate(sizes).astype(np.int64))], ["gram", "name", "n"])


def _common(docs: DataFrame, k: int, n_rows: int) -> np.ndarray:
    """Shingles that many different texts of a sample have: at most the sample's shingles by ``COMMON``.

    The sample grows with the table once a shingle of ``PAIRED`` sets would else
    be missing from it: such a shingle in the prefixes makes one cluster of its
    sets, and a few of them chain most of a large table together.
    """
    share = 2 * COMMON / PAIRED
    if n_rows * share <= SAMPLE_ROWS:
        picked = docs.select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).distinct()
        rows = docs.join(F.broadcast(picked.withColumnRenamed("id", "pick")), F.col("id").eqNullSafe(F.col("pick")))
    else:
        rows = docs.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, own in tokens.shingle_sets(batch.column("text"), k):
                if len(own):
                    yield _key_batch([own], [np.full(len(own), _set_names(own))], [np.full(len(own), len(own))])

    grams = (rows.select("text").mapInArrow(work, "gram long, name long, n long").select("gram", "name").distinct()
             .groupBy("gram").agg(F.count(F.lit(1)).alias("sets")).filter(F.col("sets") >= COMMON))
    return np.sort(grams.select("gram").toArrow().column("gram").to_numpy().astype(np.int64).view(np.uint64))


class _Tree:
    """A signature tree over sets lo to hi of a list: node (level, i) has FANOUT ** level of them."""

    def __init__(self, lo: int, bitmaps: np.ndarray, sizes: np.ndarray) -> None:
        self.lo, self.n = lo, len(sizes)
        ones = np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, ones)]
        while len(self.levels[-1][1]) > 1:
            maps, least, most, few = self.levels[-1]
            heads = np.arange(0, len(least), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, heads, axis=0), np.minimum.reduceat(least, heads),
                                np.maximum.reduceat(most, heads), np.minimum.reduceat(few, heads)))

    def span(self, level: int, i: int) -> tuple[int, int]:
        width = FANOUT ** level
        return self.lo + i * width, self.lo + min((i + 1) * width, self.n)

    def children(self, level: int, i: int) -> range:
        return range(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1][1])))


def links(sets: list[np.ndarray], split: int | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever all links connect; with ``split``, only links across that place count."""
    sizes = np.array([len(s) for s in sets])
    bits = 64 * BITMAP_WORDS
    bitmaps = np.zeros((len(sets), BITMAP_WORDS), dtype=np.uint64)
    for i, s in enumerate(sets):
        at = (s % np.uint64(bits)).astype(np.int64)
        np.bitwise_or.at(bitmaps[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    roots = np.arange(len(sets))
    out: list[tuple[int, int]] = []

    def compare(i: int, j: int) -> None:
        if roots[i] == roots[j]:
            return
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= PERCENT * (sizes[i] + sizes[j] - both):
            out.append((i, j))
            roots[roots == roots[j]] = roots[i]

    def possible(a: tuple, i: int, b: tuple, j: int) -> bool:
        (maps_a, least_a, most_a, few_a), (maps_b, least_b, most_b, few_b) = a, b
        if 100 * most_a[i] < PERCENT * least_b[j] or 100 * most_b[j] < PERCENT * least_a[i]:
            return False
        shared = int(np.bitwise_count(maps_a[i] & maps_b[j]).sum())
        # Each bit of a set that the other side lacks is a shingle that it lacks.
        overlap = min(most_a[i] - max(0, few_a[i] - shared), most_b[j] - max(0, few_b[j] - shared))
        return (100 + PERCENT) * overlap >= PERCENT * (least_a[i] + least_b[j])

    def walk(one: _Tree, two: _Tree) -> None:
        stack = [(len(one.levels) - 1, 0, len(two.levels) - 1, 0)]
        while stack:
            la, i, lb, j = stack.pop()
            (a0, a1), (b0, b1) = one.span(la, i), two.span(lb, j)
            linked = np.concatenate([roots[a0:a1], roots[b0:b1]])
            if (linked == linked[0]).all() or not possible(one.levels[la], i, two.levels[lb], j):
                continue
            if la == 0 and lb == 0:
                if one is not two or i < j:
                    compare(a0, b0)
                continue
            if la >= lb and la > 0:
                pairs = [(la - 1, c, lb, j) for c in one.children(la, i)]
                if one is two and la == lb:
                    kids = list(one.children(la, i))
                    pairs = ([(la - 1, c, la - 1, d) for c in kids for d in kids if c <= d] if i == j
                             else [(la - 1, c, lb - 1, d) for c in kids for d in two.children(lb, j)])
            else:
                pairs = [(la, i, lb - 1, d) for d in two.children(lb, j)]
            # Nodes that lie close together come first: their sets are the likeliest links.
            stack.extend(sorted(pairs, key=lambda p: -abs(p[1] - p[3])))

    if split is None:
        tree = _Tree(0, bitmaps, sizes)
        walk(tree, tree)
    elif 0 < split < len(sets):
        walk(_Tree(0, bitmaps[:split], sizes[:split]), _Tree(split, bitmaps[split:], sizes[split:]))
    return out


def _link_leaves(k: int):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        column = pa.array([r[3] for r in rows], pa.string())
        sets = [s for _, s in tokens.shingle_sets(column, k)]
        # Sets of equal smallest shingle lie side by side.
        order = sorted(range(len(rows)), key=lambda i: (rows[i][1], int(sets[i][0]), len(sets[i])))
        split = sum(not rows[i][1] for i in order)
        found = links([sets[i] for i in order], None if split == len(rows) else split)
        names = [rows[i][2] for i in order]
        return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in found], pa.int64()),
                                           pa.array([names[j] for _, j in found], pa.int64())], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("pair", "second", "name", "text"))):
                if row[0] != last and rows:
                    yield solve(rows)
                    rows = []
                last = row[0]
                rows.append(row)
        if rows:
            yield solve(rows)

    return work


def _leaf_pairs(members: DataFrame) -> DataFrame:
    """(pair, second, name) for members (name, n, root): each pair of leaves whose sizes can link, and each leaf itself."""
    # Sizes of one class differ by less than the similarity, so links join a class with itself and the next one.
    # A cluster that is no larger than a leaf is one leaf.
    step = F.lit(100 / PERCENT)
    totals = members.groupBy("root").agg(F.count(F.lit(1)).alias("total"))
    by_size = F.floor(F.log(F.col("n").cast("double")) / F.log(step))
    sized = members.join(totals, "root").withColumn("size_class", F.when(F.col("total") > LEAF, by_size).otherwise(F.lit(0)))
    counts = sized.groupBy("root", "size_class").agg(F.ceil(F.count(F.lit(1)) / F.lit(LEAF)).alias("slices"))
    placed = sized.join(counts, ["root", "size_class"]).withColumn(
        "slice", F.pmod(F.xxhash64("name"), F.col("slices")))
    leaves = counts.select("root", "size_class", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    other = leaves.select(F.col("root").alias("root2"), F.col("size_class").alias("class2"), F.col("slice").alias("slice2"))
    # A size class also reaches two classes on where rounding puts a size on an edge.
    near = (F.col("root") == F.col("root2")) & (F.col("class2") - F.col("size_class")).between(0, 2)
    pairs = (leaves.join(other, near)
             .filter((F.col("class2") > F.col("size_class")) | (F.col("slice2") >= F.col("slice")))
             .withColumn("pair", F.concat_ws(":", "root", "size_class", "slice", "class2", "slice2")))
    alone = (F.col("size_class") == F.col("class2")) & (F.col("slice") == F.col("slice2"))
    first = pairs.select("root", "size_class", "slice", "pair", F.lit(False).alias("second"))
    then = pairs.filter(~alone).select("root", F.col("class2").alias("size_class"), F.col("slice2").alias("slice"), "pair",
                                       F.lit(True).alias("second"))
    return placed.join(first.unionAll(then), ["root", "size_class", "slice"]).select("pair", "second", "name")


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, text_hash, n, group, least) of every row: least is the smallest id of the group; both null without words."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = settle(_sets(base, k), "rows")
    sets = settle(rows.filter("n > 0").groupBy("name").agg(
        F.min("id").alias("low"), F.first("n").alias("n")), "sets")
    common = docs.sparkSession.sparkContext.broadcast(_common(base, k, rows.count()))
    keys = _keys(base, k, common)
    shared = (keys.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
              .select(F.col("gram").alias("shared")))
    held = settle(keys.join(shared, F.col("gram") == F.col("shared"), "left_semi").distinct(), "keys")
    groups = held.groupBy("gram").agg(F.min("name").alias("hub"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    grouped = settle(held.join(groups, "gram"), "groups")
    many = grouped.filter(F.col("sets") > PAIRED).filter("name <> hub").select("name", "hub").distinct()
    few = grouped.filter(F.col("sets") <= PAIRED).select("gram", "name", "n")
    other = few.select("gram", F.col("name").alias("hub"), F.col("n").alias("m"))
    alike = (F.col("name") < F.col("hub")) & (100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m"))
    # Sets that share a shingle with many others are in its cluster anyway, so that counting the rest is enough.
    pairs = (few.join(other, "gram").filter(alike).groupBy("name", "hub")
             .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("n", "m")).alias("n"))
             .filter(F.col("shared") >= _shared_least_col("n")).select("name", "hub"))
    edges = many.unionAll(pairs)
    clusters = components(edges, "name", "hub")
    members = settle(clusters.join(sets, F.col("node") == F.col("name")).select("name", "n", "low", "root"), "members")
    pairs = settle(_leaf_pairs(members), "pairs")
    # One row brings the text of each set.
    brought = members.select(F.col("low").alias("want"), F.col("name"))
    texts = (base.join(brought, F.col("id").eqNullSafe(F.col("want")))
             .select("name", "id", "text"))
    named = _check_names(texts, k).dropDuplicates(["name"])
    work = (pairs.join(named, "name").select("pair", "second", "name", "text")
            .repartition("pair").sortWithinPartitions("pair"))
    found = settle(work.mapInArrow(_link_leaves(k), "a long, b long"), "links")
    groups = components(found, "a", "b")
    lows = (groups.join(sets, F.col("node") == F.col("name")).groupBy("root").agg(F.min("low").alias("least"))
            .select(F.col("root").alias("of"), "least"))
    ids = groups.join(lows, F.col("root") == F.col("of")).select("node", "root", "least")
    each = (sets.join(ids, F.col("name") == F.col("node"), "left")
            .select(F.col("name").alias("set"), F.coalesce("root", "name").alias("group"),
                    F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("least")))
    return rows.join(each, F.col("name") == F.col("set"), "left").select("id", "text_hash", "n", "group", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = tokens.SHINGLE_WORDS) -> DataFrame:
    """``id_col``, n_shingles, component_id (smallest id reachable by links) of every row.

    A-Z are lower-cased.  A text with fewer than ``k`` words has its whole
    sequence as one shingle; one without words, or null, has none and is linked
    with nothing, and its component is its own id.  Rows of equal sets, also of
    one id, are linked.  A null id counts only where a component has no other.
    Other columns are not looked at; an empty table gives no rows.  Shingles
    and sets are known by 64-bit hashes.
    """
    return _grouped(docs, id_col, text_col, k).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def _check_names(texts: DataFrame, k: int) -> DataFrame:
    """Rows (name, text) of which the text has the set of that name: an id can have several texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name").to_pylist()
            keep = np.zeros(batch.num_rows, dtype=bool)
            for row, grams in tokens.shingle_sets(batch.column("text"), k):
                keep[row] = len(grams) > 0 and _set_names(grams) == names[row]
            yield batch.select(["name", "text"]).filter(pa.array(keep))

    return texts.mapInArrow(work, "name long, text string")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         k: int = tokens.SHINGLE_WORDS) -> DataFrame:
    """One row of each group of linked rows, with all its columns: that of the smallest id.

    Rows without words are linked with nothing and all stay.  Of several rows
    with the smallest id of a group, that of the smallest text hash is taken.
    """
    found = _grouped(docs, id_col, text_col, k).filter("n > 0 and id <=> least")
    stay = found.groupBy("group").agg(F.min("least").alias("stays"), F.min("text_hash").alias("stays_hash")).drop("group")
    hash_col = fresh(docs, "text_hash")
    empty = docs.filter(~F.coalesce(F.col(text_col), F.lit("")).rlike(_WORD))
    full = docs.filter(F.coalesce(F.col(text_col), F.lit("")).rlike(_WORD)).withColumn(hash_col, F.xxhash64(text_col))
    stay = stay.select(F.col("stays").alias(fresh(full, "stays")), F.col("stays_hash").alias(fresh(full, "stays_hash")))
    kept = full.join(stay, same([full[id_col], full[hash_col]], [stay[c] for c in stay.columns]), "left_semi")
    return kept.dropDuplicates([id_col, hash_col]).drop(hash_col).unionByName(empty)
