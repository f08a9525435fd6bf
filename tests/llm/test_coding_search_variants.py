"""Byte-pair coding, hard negatives and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from wavemeld.llm import bpe, negatives, queries, variants

FILE = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 12: byte-pair encoding and decoding ------------------------------------------

@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.load_vocabulary(FILE, public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def round_trip(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_random_texts_as_by_the_library(coder, library):
    rng = random.Random(5)
    bits = ["<|endoftext|>", "<|endoftext|", "   ", "'re", "'S", "\r\n", "\x1c", "\x85", "　", "x" * 300, "ab" * 90,
            "漢字かな", "é", "é", "\U0001f600", "12345", "\x00", "﻿"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) if rng.random() < 0.3 else rng.choice("abcdef tnr \n'09.,") for _ in range(30))
        ids = library.encode(text, add_special_tokens=False).ids
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert coder.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_scans_and_heap_merge_alike(coder):
    rng = random.Random(6)
    for size in [1, 2, 3, 10, 100, 127, 128, 129, 400]:
        for letters in ("a", "ab", "etaoin", "the "):
            word = "".join(rng.choice(letters) for _ in range(size)).encode()
            assert bpe.merge_short(word, coder.v) == bpe.merge_long(word, coder.v)


def test_a_very_long_word(coder, library):
    for text in ("a" * 60_000, "x7" * 30_000, "é" * 20_000):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_of_words_is_bounded(coder, monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    small = bpe.Coder(coder.v)
    text = " ".join(f"word{i}" for i in range(50))
    assert np.frombuffer(small.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(small) <= 5


def test_odd_rows_are_coded(spark, library):
    texts = [(1, None), (1, None), (2, ""), (None, "no id"), (3, "<|endoftext|>x"), (4, " \n\t "), (5, "a" * 5000)]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in texts], "doc_id long, text string, ids string, n_tokens int")
    got = rows(bpe.round_trips(df.repartition(3), FILE, public_tokenizers.PATTERN))
    assert got == sorted([(i, *round_trip(library, t)) for i, t in texts], key=repr)
    assert bpe.round_trips(df.filter("false"), FILE, public_tokenizers.PATTERN).count() == 0
    kept = bpe.encode_documents(df, FILE, public_tokenizers.PATTERN)
    assert kept.columns == ["doc_id", "text", "ids", "n_tokens", "_ids"]
    assert {r["doc_id"]: list(r["_ids"]) for r in kept.collect()}[3] == [50256, 87]


def test_all_documents_are_coded(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.op12_bpe_encoding(spark, SF))
    assert got == sorted([(i, *round_trip(library, t)) for i, t in docs], key=repr)


# -- 11: hard negatives -------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def plain_negatives(data, every=3, top=5, scale=256):
    used = [(i, label, [math.floor(x * scale) if abs(x) < 2 ** 53 else int(x) * scale for x in v])
            for i, v, label in data if i is not None and label is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b))))

    out = []
    for r, (i, label, v) in enumerate(used):
        if i % every:
            continue
        others = [(-score(v, w), j, k) for k, (j, _, w) in enumerate(used) if k != r]
        same = sorted(x for x in others if used[x[2]][1] == label)[:top]
        rest = sorted(x for x in others if used[x[2]][1] != label)
        for p, j, _ in same:
            fit = [x for x in rest if 80 * -p <= 100 * -x[0] <= 100 * -p][:top]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, data, **options):
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    return sorted(tuple(r) for r in negatives.mine_negatives(df, F.col("vec_id") % 3 == 0, **options).collect())


def cloud(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    labels = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 4, n))
    data = (centres[labels] * spread + rng.normal(size=(n, width))) * rng.exponential(1.0, n)[:, None]
    return [(i, [float(x) for x in v], int(label)) for i, (v, label) in enumerate(zip(data, labels))]


@pytest.mark.parametrize("block_rows,anchor_rows,bucket,dense", [(40, 10, 8, 0.1), (40, 10, 8, 1.0), (1000, 1000, 64, 0.5)])
def test_negatives_as_by_brute_force(spark, monkeypatch, block_rows, anchor_rows, bucket, dense):
    monkeypatch.setattr(negatives, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(negatives, "DENSE", dense)
    data = cloud(150, 6, 1)
    assert mined(spark, data, block_rows=block_rows, anchor_rows=anchor_rows) == plain_negatives(data)


def test_odd_vectors(spark):
    data = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 2), (None, [1.0, 2.0], 1), (3, None, 1),
            (3, [1.0, None], 1), (3, [math.nan, 1.0], 1), (6, [math.inf, 1.0], 2), (6, [1.0, 2.0], None), (9, [], 1),
            (9, [0.0, 0.0], 2), (12, [1.0], 2), (1, [1.0, 1.9, 5.0], 2), (2, [0.9, 2.0], 2), (4, [-1.0, -2.0], 2),
            (15, [1e200, -1e180], 1), (16, [1e200, 0.0], 1), (17, [9e199, 0.0], 2), (18, [200.0, 200.0], 2),
            (19, [1e9, 1e9], 1), (21, [8e8, 8e8], 2), (22, [9.5e8, 9.9e8], 1)]
    got = mined(spark, data)
    assert got == plain_negatives(data) and len(got) > 20
    assert mined(spark, data, block_rows=4, anchor_rows=2) == got
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []
    extra = spark.createDataFrame([(*x, "a", 1, 2) for x in data], VECTORS + ", block string, row int, anchor int")
    assert sorted(map(tuple, negatives.mine_negatives(extra, F.col("vec_id") % 3 == 0).collect())) == got


def test_pruned_search_loses_nothing(monkeypatch):
    """With narrow clusters most vectors are never verified, and the result is that of all products."""
    monkeypatch.setattr(negatives, "BUCKET_ROWS", 128)
    monkeypatch.setattr(negatives, "DENSE", 0.5)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16)) * 4
    data = np.floor((centres[np.arange(3000) % 60] + rng.normal(size=(3000, 16)) * 0.3) * 50).astype(np.int64)
    table = pa.table({"row": np.arange(3000), "id": np.arange(3000), "label": np.zeros(3000, dtype=np.int64),
                      "vector": [v.astype("<i2").tobytes() for v in data], "small": [True] * 3000,
                      "length": np.sqrt((data ** 2).sum(axis=1).astype(float))})
    anchors = table.slice(0, 40)
    low = negatives.LONG
    for name, value in (("least", -low - 1), ("most", low)):
        anchors = anchors.append_column(name, pa.array([[value]] * 40, pa.list_(pa.int64())))
    verified = []
    plain = negatives.scores
    monkeypatch.setattr(negatives, "scores", lambda a, b: (verified.append(len(a.row) * len(b.row)), plain(a, b))[1])
    got = negatives.search_blocks(anchors, table, 5, True).to_pylist()
    exact = data[:40] @ data.T
    want = {i: sorted(((-s, j) for j, s in enumerate(exact[i].tolist()) if j != i))[:5] for i in range(40)}
    assert {i: [(-r["score"], r["id"]) for r in got if r["anchor_row"] == i] for i in range(40)} == want
    assert sum(verified) < 0.6 * 40 * 3000


def test_query_agrees_with_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLES["op11_hard_negatives"]).fetchall())
    assert sorted(map(tuple, queries.op11_hard_negatives(spark, SF).collect())) == want


# -- 13: spelling variants ----------------------------------------------------------

def plain_counts(data, erase=97):
    total = Counter()
    for i, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % erase == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    return total


def plain_near(words):
    near = {w: set() for w in words}
    gaps = {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1:]), set()).add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(counts, min_count=3, min_letters=5):
    n = {w: c for w, c in counts.items() if c >= min_count and len(w) >= min_letters}
    near = plain_near(n)
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted([(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n], key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    base = ["garden", "gardens", "gardener", "straße", "colour", "color", "aaaaa", "aaaaaa", "aaaaaaa", "ababab"]
    out = [(i, " ".join(w[:k] + rng.choice("aeréX") + w[k + rng.randint(0, 1):] if rng.random() < 0.5 else w
                        for w in rng.choices(base, k=40) for k in [rng.randrange(len(w))])) for i in range(80)]
    return out + [(None, "garden Garden GARDEN"), (None, "garden Garden GARDEN"), (7, None), (8, ""), (9, " \n"),
                  (10, "gardœn garœden 中garden7garden_garden"),
                  (12, "chainab " * 3 + "chainabc " * 8 + "chainabcd " * 20), (11, ("z" * 3000 + " ") * 4 + "z" * 2999)]


@pytest.mark.parametrize("part_letters", [variants.PART_LETTERS, 30])
def test_variants_as_by_brute_force(spark, texts, part_letters):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in texts], "doc_id long, text string, word string, n int, size int")
    got = rows(variants.group_variants(df.repartition(3), part_letters=part_letters))
    assert got == plain_variants(plain_counts(texts)) and len(got) > 50
    assert any(r[1] and r[1] != r[2] for r in got)


def test_no_texts_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.group_variants(empty).collect() == []


def test_all_documents_have_their_variants(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op13_spelling_variants(spark, SF)) == plain_variants(plain_counts(docs))


def test_composition_finds_each_pair_once():
    rng = random.Random(2)
    for letters, n in (("ab", 40), ("abc", 200), ("a", 12)):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 12 if letters == "a" else 6)))
                        for _ in range(n)})
        machine = variants.minimal_acceptor(words)
        pairs = [frozenset((words[i], words[j])) for i, j in variants.compose(machine)]
        near = plain_near(words)
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {frozenset((w, x)) for w, others in near.items() for x in others}


def test_acceptor_is_minimal():
    """As many states as there are different sets of endings."""
    words = sorted({a + b for a in ("", "x", "yy", "xy") for b in ("ing", "ed", "s", "")})
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in
               (w[:k] for k in range(len(w) + 1))}
    assert len(variants.minimal_acceptor(words).arcs) == len(endings)


def test_words_that_share_a_half_are_cut_down(spark):
    """A third of a vocabulary may begin alike: its part is halved until it is small."""
    rng = random.Random(4)
    words = {"prefix" + "".join(rng.choice("abcde") for _ in range(6)) for _ in range(600)}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    parts = variants.initial_states(df, 5, 200)
    assert parts.groupBy("key").count().agg(F.max("count")).first()[0] < 60
    got = {(r["word"], r["near"]) for r in variants.near_words(df, 5, 200).collect()}
    assert got == {(w, x) for w, near in plain_near(words).items() for x in near}


def test_checksums_are_put_together():
    shift = variants.Shifts()
    for a, b in ((b"12:", b"word"), (b"", b"x"), (b"-7:", "été".encode())):
        assert shift(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_long_texts_are_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(variants, "CHUNK_LETTERS", 100)
    monkeypatch.setattr(variants, "COUNTED", 3)
    data = [(i, f"alpha beta{i % 3}gamma delta " * 20) for i in range(20)]
    got: dict = {}
    for batch in [pa.RecordBatch.from_arrays([pa.array([str(i) for i, _ in data]), pa.array([t for _, t in data])],
                                             ["doc_id", "text"])]:
        for piece in variants._pieces(batch):
            variants.count_texts(piece.column(0).to_pylist(), piece.column(1).to_pylist(), 97, got)
    assert {w.decode("latin-1"): n for w, n in got.items()} == dict(plain_counts(data))
