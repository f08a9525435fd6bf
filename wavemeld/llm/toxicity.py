"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel counts common subsequences of three letters, where each letter that
is skipped in either string lowers the count, so an insult with a letter put
in or left out stays close to the plain one.  Landmarks are strings from the
labelled sentences; a text's kernel values against them (the best of its words)
are mapped by Nyström's method, and a linear machine is trained on the map.
Training sees a bounded sample of labelled rows; scoring sees every word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wavemeld.llm import tokens
from wavemeld.llm.common import fit_in_task, settle

#: Labelled rows to fit on, for each label.
SAMPLE_ROWS = 3000
LANDMARKS = 64
ORDER, DECAY = 3, 0.7
STEM, LONGEST = 4, 16
#: Letters by which a piece of a word may be longer than the landmark.
GAPS = 2
#: Kernel values below this are noise of unrelated words and count as 0.
LEAST = 0.3
THRESHOLD = 0.7
RIDGE = 3e-2
SINGLES = 4

_LETTER = np.zeros(256, dtype=np.uint64)
for _b in range(256):
    if _b not in (9, 10, 11, 12, 13, 32):
        _LETTER[_b] = np.uint64(1) << np.uint64((_b * 2654435761 >> 7) % 64 if not 97 <= _b <= 122 else _b - 97)


#: ASCII characters that are neither letters, digits nor white space.
_MARK = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)])


def kernel(words: np.ndarray, sizes: np.ndarray, other: bytes) -> np.ndarray:
    """Subsequence kernel of byte strings (rows of a matrix, padded by 0) and one string."""
    n, width = words.shape
    m = len(other)
    # prefix[j]: weighted common subsequences of length i of the word so far and other[:j].
    table = np.ones((width + 1, m + 1, n), dtype=np.float32)
    total = np.zeros(n, dtype=np.float32)
    match = [[(words[:, s] == other[t]) for t in range(m)] for s in range(width)]
    for order in range(1, ORDER + 1):
        nxt = np.zeros_like(table)
        for s in range(1, width + 1):
            run = np.zeros(n, dtype=np.float32)
            for t in range(1, m + 1):
                hit = match[s - 1][t - 1]
                if order == ORDER:
                    total += np.where(hit, table[s - 1, t - 1] * DECAY ** 2, 0)
                else:
                    run = DECAY * run + np.where(hit, table[s - 1, t - 1] * DECAY ** 2, 0)
                    nxt[s, t] = DECAY * nxt[s - 1, t] + run
        table = nxt
    return total


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(strings), width), dtype=np.uint8)
    for i, s in enumerate(strings):
        out[i, :len(s)] = np.frombuffer(s, np.uint8)
    return out, np.array([len(s) for s in strings])


def _self(words: np.ndarray) -> np.ndarray:
    """Kernel of each row with itself."""
    n, width = words.shape
    table = np.ones((width + 1, width + 1, n), dtype=np.float32)
    total = np.zeros(n, dtype=np.float32)
    for order in range(1, ORDER + 1):
        nxt = np.zeros_like(table)
        for s in range(1, width + 1):
            run = np.zeros(n, dtype=np.float32)
            for t in range(1, width + 1):
                hit = (words[:, s - 1] == words[:, t - 1]) & (words[:, s - 1] > 0)
                if order == ORDER:
                    total += np.where(hit, table[s - 1, t - 1] * DECAY ** 2, 0)
                else:
                    run = DECAY * run + np.where(hit, table[s - 1, t - 1] * DECAY ** 2, 0)
                    nxt[s, t] = DECAY * nxt[s - 1, t] + run
        table = nxt
    return total


def similarity(words: list[bytes], other: bytes) -> np.ndarray:
    """Normalised kernel of strings with one string."""
    matrix, sizes = _matrix(words, max(map(len, words)))
    theirs = _self(np.frombuffer(other, np.uint8)[None, :])[0]
    own = _self(matrix)
    return np.where(own > 0, kernel(matrix, sizes, other) / np.sqrt(np.maximum(own, 1e-12) * theirs), 0)


@dataclass
class Model:
    """Landmarks, Nyström's map, the machine's weights and the two numbers of its calibration."""

    landmarks: list[bytes]
    root: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = _mapped(features, self.root) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _mapped(features: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Nyström's map, and the kernel value of the nearest landmark beside it."""
    return np.column_stack([features @ root, features.max(axis=1, initial=0)])


class Scorer:
    """Kernel features of whole batches of texts."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.landmarks = landmarks
        self.letters = [np.bitwise_or.reduce(_LETTER[np.frombuffer(z, np.uint8)]) for z in landmarks]
        self.norms = [float(_self(np.frombuffer(z, np.uint8)[None, :])[0]) for z in landmarks]
        distinct = np.arange(1, 64, dtype=np.uint8)
        self.least = [float(_self(distinct[None, :n])[0]) if n else 0.0
                      for n in range(max(map(len, landmarks), default=0) + GAPS + 1)]
        self.pairs = [np.bitwise_or.reduce(_pair(np.frombuffer(z[:-1], np.uint8), np.frombuffer(z[1:], np.uint8)))
                      for z in landmarks]

    def features(self, column: pa.Array) -> np.ndarray:
        """The best normalised kernel value of a text's words, for each landmark."""
        out = np.zeros((len(column), len(self.landmarks)), dtype=np.float64)
        if not self.landmarks:
            return out
        for chunk in tokens.words(column):
            extra = _spelled(chunk)
            for found in (chunk, extra):
                if found is not None and len(found.starts):
                    self._chunk(found, out)
        return out

    def _chunk(self, chunk: tokens.Words, out: np.ndarray) -> None:
        hashes = chunk.hashes()
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = chunk.starts[sample], chunk.ends[sample]
        order = np.argsort(starts, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        which = back[which]
        starts, sizes = starts[order], (ends - starts)[order]
        flat = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
        data = chunk.data[flat]
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        letters = np.bitwise_or.reduceat(_LETTER[data], begin)
        word = np.repeat(np.arange(len(sizes)), sizes)
        pairs = np.zeros(len(data), dtype=np.uint64)
        for gap in range(1, GAPS + 1):
            if len(data) > gap:
                inside = word[gap:] == word[:-gap]
                pairs[:-gap] |= np.where(inside, _pair(data[:-gap], data[gap:]), np.uint64(0))
        pairs = np.bitwise_or.reduceat(pairs, begin)
        values = np.zeros((len(sizes), len(self.landmarks)), dtype=np.float32)
        hit = np.zeros(len(sizes), dtype=bool)
        for j, z in enumerate(self.landmarks):
            # A word that is close to the landmark has most of its letters, and most of its pairs at small gaps.
            able = np.flatnonzero((np.bitwise_count(letters & self.letters[j])
                                   >= np.bitwise_count(self.letters[j]) - 1)
                                  & (np.bitwise_count(pairs & self.pairs[j])
                                     >= max(1, int(np.bitwise_count(self.pairs[j])) - 1)))
            if not len(able):
                continue
            best = self._pieces(data, begin[able], sizes[able], j)
            keep = best >= LEAST
            values[able[keep], j] = best[keep]
            hit[able[keep]] = True
        if hit.any():
            text = chunk.rows.start + chunk.text_of_word() if chunk.rows else chunk.text_of_word()
            at = np.flatnonzero(hit[which])
            np.maximum.at(out, text[at], values[which[at]])

    def _pieces(self, data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, j: int) -> np.ndarray:
        """The best value over the pieces of each word that are as long as the landmark or a little longer."""
        z = self.landmarks[j]
        best = np.zeros(len(sizes), dtype=np.float32)
        for width in range(len(z), len(z) + GAPS + 1):
            # A shorter word is one piece, at the first width.
            long = np.flatnonzero((sizes >= width) | (width == len(z)))
            places = np.maximum(sizes[long] - width, 0) + 1
            word = np.repeat(long, places)
            start = begin[word] + np.arange(len(word)) - np.repeat(np.cumsum(places) - places, places)
            end = begin[word] + sizes[word]
            for part in np.split(np.arange(len(word)), range(20_000, len(word), 20_000)):
                at = start[part, None] + np.arange(width)
                matrix = np.where(at < end[part, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
                mask = np.bitwise_or.reduce(_LETTER[matrix] * (matrix > 0), axis=1)
                able = np.flatnonzero(np.bitwise_count(mask & self.letters[j]) >= np.bitwise_count(self.letters[j]) - 1)
                if not len(able):
                    continue
                rows, back = np.unique(matrix[able], axis=0, return_inverse=True)
                shared = kernel(rows, np.full(len(rows), width), z)
                full = np.zeros(len(rows), dtype=np.float32)
                # No string of this length is less like itself than one without a repeated letter.
                near = np.flatnonzero(shared >= np.sqrt(LEAST) * np.sqrt(self.least[min(width, len(self.least) - 1)] * self.norms[j]))
                if len(near):
                    full[near] = shared[near] / np.sqrt(np.maximum(_self(rows[near]), 1e-12) * self.norms[j])
                np.maximum.at(best, word[part[able]], full[back.ravel()])
        # The square of a kernel is one too, and sets chance likenesses apart from real ones.
        return np.minimum(best, 1) ** 2


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A bit for each pair of letters."""
    return np.uint64(1) << ((a.astype(np.uint64) * np.uint64(31) + b.astype(np.uint64) * np.uint64(7)) % np.uint64(64))


def _spelled(chunk: tokens.Words) -> tokens.Words | None:
    """Words that are spelled apart (``i d i o t``, ``id.iot``), put together, as words of their own."""
    text, found = chunk.text_of_word(), []
    single = (chunk.ends - chunk.starts == 1).astype(np.int8)
    edges = np.flatnonzero(np.concatenate([[1], (np.diff(single) != 0) | (np.diff(text) != 0), [1]]))
    runs = np.flatnonzero((single[edges[:-1]] == 1) & (np.diff(edges) >= SINGLES)) if len(single) else []
    for run in runs:
        a, b = edges[run], edges[run + 1]
        found.append((text[a], chunk.data[chunk.starts[a:b]]))
    mark = _MARK[chunk.data]
    after = np.flatnonzero(mark[:-1] & ~mark[1:] & ~tokens._SPACE[chunk.data[1:]]) + 1
    words = np.unique(np.searchsorted(chunk.starts, after, side="right") - 1)
    for word in words[words >= 0]:
        begin, end = chunk.starts[word], chunk.ends[word]
        if not mark[begin]:
            found.append((text[word], chunk.data[begin:end][~mark[begin:end]]))
    if not found:
        return None
    found.sort(key=lambda x: x[0])
    sizes = np.array([len(d) for _, d in found])
    ends = np.cumsum(sizes)
    return tokens.Words(chunk.rows, np.concatenate([d for _, d in found]), ends - sizes, ends,
                        np.searchsorted(np.array([t for t, _ in found]), np.arange(len(chunk.first))))


def _mine(texts: list[bytes], labels: np.ndarray, most: int) -> list[bytes]:
    """Words and word beginnings that together cover the toxic texts, and hardly any other."""
    seen: dict[bytes, list[int]] = {}
    for i, text in enumerate(texts):
        strings: set[bytes] = set()
        for word in text.split():
            word = word.strip(b".,;:!?\"'()[]*#%$&|")
            if len(word) >= STEM:
                strings.update((word[:STEM], word[:STEM + 1], word[:LONGEST]))
        for s in strings:
            seen.setdefault(s, []).append(i)
    clean = max(1, int((labels == 0).sum()))
    candidates = []
    for s, rows in seen.items():
        bad = [i for i in rows if labels[i]]
        good = len(rows) - len(bad)
        # At most one clean text in five hundred has it, and three toxic ones at least.
        if len(bad) >= 3 and good <= max(0.002 * clean, 0) and len(bad) > 20 * good:
            candidates.append((s, frozenset(bad)))
    # Words of a few texts only are chance.
    least, common = max(3, round(0.004 * int(labels.sum()))), max(3, round(0.03 * int(labels.sum())))
    chosen, left = [], frozenset(np.flatnonzero(labels).tolist())
    while candidates and len(chosen) < most:
        s, rows = max(candidates, key=lambda c: (len(c[1] & left), len(c[1]), len(c[0]), c[0]))
        if len(rows & left) < least and len(rows) < common:
            candidates.remove((s, rows))
            continue
        chosen.append(s)
        left -= rows
        # The same word under another name adds nothing.
        candidates = [c for c in candidates if c[0] != s and not c[0].startswith(s) and not s.startswith(c[0])]
    return chosen


def fit(texts: list[str | None], labels: list[int], landmarks: int = LANDMARKS) -> Model:
    """Fit on labelled texts; without a toxic text or without a clean one the model knows nothing and scores low."""
    # Copies say nothing new; of one that has both labels, the toxic one counts.
    both: dict[str, int] = {}
    for text, label in zip(texts, labels):
        both[text or ""] = max(both.get(text or "", 0), 1 if label else 0)
    texts, labels = sorted(both), [both[t] for t in sorted(both)]
    raw = [tokens._FOLD[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts]
    y = np.array(labels, dtype=int)
    strings = _mine(raw, y, landmarks) if len(y) and 0 < y.sum() < len(y) else []
    if not strings:
        return Model([], np.zeros((0, 0)), np.zeros(1), -1.0, 1.0, -2.0)
    x = Scorer(strings).features(pa.array(texts, pa.string()))
    gram = np.array([[float(similarity([a], b)[0]) ** 2 for b in strings] for a in strings])
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    z = _mapped(x, root)
    weights, bias = _machine(z, 2 * y - 1)
    margin = z @ weights + bias
    slope, shift = _calibrate(margin, y)
    return Model(strings, root, weights, bias, slope, shift)


def _machine(z: np.ndarray, sign: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> tuple[np.ndarray, float]:
    """Linear machine on the squared hinge loss, both labels weighing the same: Newton steps on the violators."""
    design = np.column_stack([z, np.ones(len(z))])
    cost = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum())
    penalty = np.diag([ridge] * z.shape[1] + [1e-9])
    wrong, beta = np.ones(len(z), dtype=bool), np.zeros(design.shape[1])
    for _ in range(steps):
        own = design[wrong] * cost[wrong, None]
        beta = np.linalg.solve(penalty + own.T @ design[wrong], own.T @ sign[wrong])
        now = sign * (design @ beta) < 1
        if (now == wrong).all() or not now.any():
            break
        wrong = now
    return beta[:-1], float(beta[-1])


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift, by Newton steps on smoothed targets."""
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - goal) + 1e-3 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(beta[0]), float(beta[1])


def held_out(id_col: str) -> Column:
    """Rows that labels are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on up to ``sample_rows`` rows of each label, drawn by a hash from those not held out.

    Rows without a label or text are not learned from; two labels of one id
    that disagree count as toxic.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
             .groupBy("id").agg(F.max("label").alias("label")))
    draw = F.xxhash64("id")
    parts = []
    # The sample's bound holds before any text is read; unknown ids leave room unused.
    for label in (0, 1):
        parts.append(known.filter(F.col("label") == label).orderBy(draw, "id").limit(sample_rows))
    sample = settle(parts[0].unionAll(parts[1]), "sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    rows = settle(texts.join(F.broadcast(sample), "id").orderBy("id", "text").limit(2 * sample_rows), "training")
    return fit_in_task(rows.select("text", "label"), fit)


def _scores(shared, place: int):
    model = shared.value
    return Scorer(model.landmarks), model, place


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted of every row.

    Null and empty texts get the score of a text without any landmark.  Texts
    of any length are scored whole; repeated rows score alike.  Other columns,
    and the id, have no part in a score.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = narrow.select("id", F.lit(0.0).alias("score")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, fitted, _ = _scores(shared, 1)
        for batch in batches:
            values = fitted.scores(scorer.features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values, pa.float64())], schema.names)

    return (narrow.mapInArrow(work, schema)
            .select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose score stays below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, fitted, place = _scores(shared, at)
        for batch in batches:
            values = fitted.scores(scorer.features(batch.column(place)))
            yield batch.filter(pa.array(values < THRESHOLD))

    return docs.mapInArrow(work, docs.schema)
