"""Spelling variants of a vocabulary, by composing its acceptor with a one-edit transducer.

Words are counted over all texts.  The pairs of words at one edit are the paths
of the composition A o E o A, where A is the minimised acceptor of the words and
E rewrites, drops or adds one letter.  No task holds the whole of A: the paths
are enumerated per initial state, i.e. for the words that enter A by the same
first letters, and for edits within those letters for the words that leave it by
the same last ones.  Of two words at one edit either the first half or the last
half is the same, so with halves as initial states no pair is lost, and each is
found once (``differ`` keeps the second way from finding what the first has).  A
part with too many letters is halved again, as often as needed; what is left
open in the middle shrinks to a letter, so every part becomes small.

Rows: null texts are empty; a null id counts as an empty one; repeated rows
count again; other columns are not read; an empty table has no words.  Ties in
the choice of a form go to the word that is smallest by code points.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.llm.common import settle

MIN_LETTERS = 5
MIN_COUNT = 3
#: A word's form occurs at least so many times as often.
FORM_RATIO = 2
#: One run of letters in so many loses a letter, by its checksum.
ERASE = 97
#: Letters of the open middles that one part may hold.
PART_LETTERS = 400_000
#: Words a task counts before it sends them on.
COUNTED = 300_000
CHUNK_LETTERS = 4_000_000
REMEMBERED = 500_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Runs of A-Z, a-z and U+00C0 to U+00FF, once texts are lower-cased Latin-1 with "?" for all other letters.
_RUNS = re.compile(rb"[a-z\xc0-\xff]+")


class Words(dict):
    """Numbers words in the order they are met, with length and checksum of each."""

    def __init__(self) -> None:
        super().__init__()
        self.sizes: list[int] = []
        self.sums: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.sizes.append(len(word))
        self.sums.append(zlib.crc32(word if word.isascii() else word.decode("latin-1").encode()))
        return number


def _utf8_sizes(words: list[bytes]) -> np.ndarray:
    return np.array([len(w) if w.isascii() else len(w.decode("latin-1").encode()) for w in words], dtype=np.int64)


class Shifts:
    """What a checksum becomes over so many more bytes: crc(a + b) = shift(crc(a), len(b)) ^ crc(b)."""

    def __init__(self) -> None:
        self.zeros: dict[int, tuple[bytes, int]] = {}

    def __call__(self, start: int, size: int) -> int:
        if size not in self.zeros:
            blank = bytes(size)
            self.zeros[size] = blank, zlib.crc32(blank)
        blank, plain = self.zeros[size]
        return zlib.crc32(blank, start) ^ plain


def count_texts(ids: list, texts: list[str | None], erase: int | None, counts: dict[bytes, int]) -> None:
    """Add the words of some texts to ``counts``.

    The checksum of ``<id>:<run>`` is put together from those of its two parts,
    so it is an array operation over all runs and not a call for each.
    """
    numbers, shifts = Words(), Shifts()
    lists = [_RUNS.findall((t or "").encode("latin-1", "replace").translate(_LOWER)) for t in texts]
    per_text = np.array([len(x) for x in lists], dtype=np.int64)
    which = np.fromiter((numbers[w] for x in lists for w in x), dtype=np.int64, count=int(per_text.sum()))
    words = list(numbers)
    kept = np.ones(len(which), dtype=bool)
    if erase and len(which):
        sizes = _utf8_sizes(words)
        used, place = np.unique(sizes, return_inverse=True)
        starts = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        table = np.array([[shifts(s, int(n)) for n in used] for s in starts], dtype=np.uint32)
        text_of = np.repeat(np.arange(len(lists)), per_text)
        sums = table[text_of, place[which]] ^ np.array(numbers.sums, dtype=np.uint32)[which]
        kept = sums % np.uint32(erase) != 0
        for number, h in zip(which[~kept].tolist(), sums[~kept].tolist()):
            at = h % numbers.sizes[number]
            word = words[number][:at] + words[number][at + 1:]
            counts[word] = counts.get(word, 0) + 1
    times = np.bincount(which[kept], minlength=len(words))
    for word, n in zip(words, times.tolist()):
        if n:
            counts[word] = counts.get(word, 0) + n


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
                erase: int | None = ERASE) -> DataFrame:
    """(word, n): how often each word of at least ``min_letters`` letters occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for part in _pieces(batch):
                count_texts(part.column(0).to_pylist(), part.column(1).to_pylist(), erase, counts)
                if len(counts) >= COUNTED:
                    yield _counted(counts, min_letters)
                    counts = {}
        yield _counted(counts, min_letters)

    narrow = docs.select(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`").cast("string"))
    return narrow.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a few million bytes, or of one text."""
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(False).astype(np.int64)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK_LETTERS, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _counted(counts: dict[bytes, int], min_letters: int) -> pa.RecordBatch:
    kept = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= min_letters]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                       pa.array([n for _, n in kept], pa.int64())], ["word", "n"])


@dataclass
class Acceptor:
    """The smallest automaton of some words; a word's place among them follows from its path.

    ``arcs[s]`` gives for each letter the next state and how many words that
    come from ``s`` stand before those with this letter.
    """

    arcs: list[dict[str, tuple[int, int]]] = field(default_factory=list)
    final: list[bool] = field(default_factory=list)
    start: int = 0


def minimal_acceptor(words: list[str]) -> Acceptor:
    """Built from different words in order: states of a branch are fixed, and shared, once no word can change them."""
    out, known, size = Acceptor(), {}, []

    def fix(arcs: dict[str, int], final: bool) -> int:
        key = (final, tuple(arcs.items()))
        state = known.get(key)
        if state is None:
            state = known[key] = len(out.arcs)
            table, before = {}, int(final)
            for letter, target in arcs.items():
                table[letter] = (target, before)
                before += size[target]
            out.arcs.append(table)
            out.final.append(final)
            size.append(before)
        return state

    # The branch of the last word: (arcs, final) of the states on its path that may still change.
    branch: list[list] = [[{}, False]]
    last = ""
    for word in words:
        shared = 0
        for a, b in zip(last, word):
            if a != b:
                break
            shared += 1
        while len(branch) - 1 > shared:
            arcs, final = branch.pop()
            branch[-1][0][last[len(branch) - 1]] = fix(arcs, final)
        branch.extend([{}, False] for _ in range(len(word) - shared))
        branch[-1][1] = True
        last = word
    while len(branch) > 1:
        arcs, final = branch.pop()
        branch[-1][0][last[len(branch) - 1]] = fix(arcs, final)
    out.start = fix(*branch[0])
    return out


def compose(a: Acceptor) -> Iterator[tuple[int, int]]:
    """Places of the words that one edit turns into each other, each pair once, the shorter word first.

    Before its edit the transducer copies, so both sides are in one state; at
    the edit they part; after it they have to agree to the end.  A letter that
    repeats the one before it is never the one added: added before its run, it
    gives the same word.
    """
    met: dict[tuple[int, int], list[tuple[int, int]]] = {}
    stored = 0
    stack: list[tuple[int, int, str]] = [(a.start, 0, "")]
    while stack:
        state, base, letter = stack.pop()
        arcs = list(a.arcs[state].items())
        for i, (c, (target, before)) in enumerate(arcs):
            stack.append((target, base + before, c))
            ways = [(other, skip, target, before) for _, (other, skip) in arcs[:i]]
            if c != letter:
                ways.append((state, 0, target, before))
            for left, left_skip, right, right_skip in ways:
                found = met.get((left, right))
                if found is None:
                    found = met[left, right] = _agree(a, left, right)
                    stored += len(found) + 1
                for i_left, i_right in found:
                    yield base + left_skip + i_left, base + right_skip + i_right
                if stored > REMEMBERED:
                    met, stored = {}, 0


def _agree(a: Acceptor, left: int, right: int) -> list[tuple[int, int]]:
    """Places, from two states on, of the endings that both accept."""
    out, stack = [], [(left, right, 0, 0)]
    while stack:
        s, t, i, j = stack.pop()
        if a.final[s] and a.final[t]:
            out.append((i, j))
        one, two = a.arcs[s], a.arcs[t]
        if len(one) <= len(two):
            stack.extend((to, two[c][0], i + skip, j + two[c][1]) for c, (to, skip) in one.items() if c in two)
        else:
            stack.extend((one[c][0], to, i + one[c][1], j + skip) for c, (to, skip) in two.items() if c in one)
    return out


def _parts(size: Column, head: Column, tail: Column, differ: Column) -> tuple[Column, Column]:
    """The two halves of an open middle, as structs (size, head, tail, differ).

    ``size`` is the length of the shorter word of a pair, ``head`` and ``tail``
    the letters that are the same, and within the first ``differ`` letters the
    words must not be the same.
    """
    middle = size - head - tail
    half = F.ceil(middle / 2).cast("int")
    def part(head: Column, tail: Column, differ: Column) -> Column:
        return F.struct(size.alias("size"), head.alias("head"), tail.alias("tail"), differ.alias("differ"))
    return (part(head + half, tail, differ), part(head, tail + middle - half, F.least(differ, head + half)))


def _keyed(df: DataFrame) -> DataFrame:
    """One row for each part of a word, with the key of its initial state."""
    ends = [F.substring(F.col("word"), F.lit(1), F.col("head")),
            F.when(F.col("tail") > 0, F.expr("right(word, tail)")).otherwise(F.lit(""))]
    return df.select("word", "n", F.inline("parts")).withColumn(
        "key", F.xxhash64("size", "head", "tail", "differ", *ends))


NO_LIMIT = (1 << 31) - 1


def initial_states(words: DataFrame, min_letters: int, part_letters: int) -> DataFrame:
    """The vocabulary dealt by initial states, none with more than about ``part_letters`` open letters."""
    size, zero, free = F.length("word"), F.lit(0), F.lit(NO_LIMIT)
    # A word is the shorter or the equal one of a pair, or the longer one of a pair whose shorter word has one less.
    both = F.array(*_parts(size, zero, zero, free), *_parts(size - 1, zero, zero, free))
    parts = settle(_keyed(words.withColumn("parts", F.filter(both, lambda p: p["size"] >= min_letters))), "parts")
    done = []
    while True:
        middle = F.col("size") - F.col("head") - F.col("tail")
        full = settle(parts.groupBy("key").agg(F.sum(middle + 1).alias("letters"), F.max(middle).alias("middle"))
                      .filter((F.col("letters") > part_letters) & (F.col("middle") > 1)).select("key"), "full")
        if full.isEmpty():
            return _union([*done, parts])
        done.append(parts.join(full, "key", "left_anti").select(*parts.columns))
        halves = F.array(*_parts(F.col("size"), F.col("head"), F.col("tail"), F.col("differ")))
        parts = settle(_keyed(parts.join(full, "key", "left_semi").withColumn("parts", halves)), "parts")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _compose_part(words: list[str], size: int, head: int, tail: int, differ: int) -> Iterator[tuple[int, int]]:
    """Positions in ``words`` of the near pairs of one part."""
    middles = [w[head:len(w) - tail] for w in words]
    order = sorted(range(len(words)), key=middles.__getitem__)
    for i, j in compose(minimal_acceptor([middles[k] for k in order])):
        a, b = order[i], order[j]
        if min(len(words[a]), len(words[b])) == size and words[a][:differ] != words[b][:differ]:
            yield a, b


def _near_in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways round, of rows that come sorted by key."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        keys = table["key"].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left")) if len(keys) else 0
        rest = table.slice(cut)
        yield from _near_in_table(table.slice(0, cut))
    if rest is not None:
        yield from _near_in_table(rest)


def _near_in_table(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    keys = table["key"].to_numpy()
    edges = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
    out: list[list] = [[], [], [], []]
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s < 2:
            continue
        part = table.slice(s, e - s)
        words, counts = part["word"].to_pylist(), part["n"].to_pylist()
        shapes = part.select(["size", "head", "tail", "differ"])
        size, head, tail, differ = [c[0].as_py() for c in shapes.columns]
        for group in _same_ends(words, head, tail):
            if len(group) < 2:
                continue
            mine = [words[i] for i in group]
            for a, b in _compose_part(mine, size, head, tail, differ):
                a, b = group[a], group[b]
                for column, values in zip(out, ((words[a], words[b]), (counts[a], counts[b]),
                                                (words[b], words[a]), (counts[b], counts[a]))):
                    column.extend(values)
        if len(out[0]) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, PAIRS)], schema=PAIRS)
            out = [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, PAIRS)], schema=PAIRS)


def _same_ends(words: list[str], head: int, tail: int) -> list[list[int]]:
    """Rows of one key by the ends they share; more than one list only where two keys have one hash."""
    groups: dict[tuple[str, str], list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault((w[:head], w[len(w) - tail:]), []).append(i)
    return list(groups.values())


def near_words(words: DataFrame, min_letters: int = MIN_LETTERS, part_letters: int = PART_LETTERS) -> DataFrame:
    """(word, n, near, near_n): all pairs of different words at one edit, both ways round.

    ``words`` has each ``word`` once, with its count ``n``.
    """
    parts = initial_states(words, min_letters, part_letters)
    return (parts.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_near_in_parts, "word string, n bigint, near string, near_n bigint"))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of the chain of forms from ``word`` on, for words that have a form.

    Each round doubles the length of the chains that are known.  Counts double
    from form to form, so chains are short and have no circle.
    """
    steps = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("far"))
        moved = (steps.join(ahead, F.col("root") == F.col("at"), "left")
                 .select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        moved = settle(moved, "roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
                   min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, erase: int | None = ERASE,
                   part_letters: int = PART_LETTERS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of all texts with the spelling each is a variant of.

    A word's form is its near word of largest count, if that is at least
    ``ratio`` times the word's own; its root is the end of the chain of forms.
    """
    words = settle(count_words(docs, doc_id, text, min_letters, erase).filter(F.col("n") >= min_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = (near_words(words, min_letters, part_letters).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    table = settle(known.select("word", F.col("best.near").alias("form"), "n", "n_near",
                                (-F.col("best.less")).alias("form_n")), "forms")
    roots = follow(table.filter("form IS NOT NULL"))
    return (table.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
