"""The operators against plain versions, on small tables with every odd row."""

import hashlib
import zlib

import plain_versions as brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF
from wavemeld.llm import chat, decontaminate, exact_dedup, jaccard, lm, packing, queries, repeats, sharding, tokens, toxicity
from wavemeld.llm.common import components, rank_in_groups, settle

WORD = [f"w{i}" for i in range(400)]
LONG = " ".join(WORD) + " tail"
ODD = [
    (1, "The same text, twice"), (2, "the SAME text, twice"), (2, "the SAME text, twice"), (3, None), (4, ""),
    (5, " \n\t "), (6, LONG), (7, LONG.replace("w200 ", "other ")), (8, LONG + " end"), (9, "É é stay apart"),
    (10, "é é stay apart"), (None, "no id at all"), (None, "no id at all"), (11, "one"), (12, "one two three four"),
    (13, "one two three four"), (14, "x" * 900), (15, LONG[:700]), (16, "y" * 5000 + LONG), (17, "a\x0bb c\x0cd e"),
]
EMPTY = "doc_id long, text string, kept string, text_key string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, repeats, empty and long texts, and columns whose names the operators use inside."""
    rows = [(i, t, "x", "y", 1, 2) for i, t in ODD]
    return settle(spark.createDataFrame(rows, "doc_id long, text string, kept string, text_key string, "
                                              "shard int, text_hash int"), "odd").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    return table, [tuple(r) for r in table.select("doc_id", "text").collect()]


# -- 1: repeated strings -----------------------------------------------------------

@pytest.mark.parametrize("length,token", [(400, 64), (40, 8)])
def test_repeats_as_by_brute_force(odd, length, token):
    want = sorted(brute.repeats(ODD, length), key=repr)
    assert rows(repeats.remove_repeats(odd, length=length, token=token)) == want
    assert rows(repeats.remove_repeats(odd, length=length, token=token, sorted_blocks=1)) == want


def test_repeats_over_a_table(documents):
    table, plain = documents
    assert rows(repeats.remove_repeats(table)) == sorted(brute.repeats(plain, 400), key=repr)


@pytest.mark.parametrize("sorted_blocks", [2, 20, repeats.SORTED_BLOCKS])
def test_repeats_by_sorting_and_by_counting_in_pieces_of_long_texts(spark, monkeypatch, sorted_blocks):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 300)
    rng = np.random.default_rng(3)
    common = "".join(rng.choice(list("abc"), 30))
    plain = [(i, "".join(rng.choice(list("abcdefgh"), 200)) + common + "".join(rng.choice(list("ab"), 9)))
             for i in range(40)]
    plain += [(99, "ab" * 600), (100, plain[3][1][50:])]
    df = spark.createDataFrame(plain, "doc_id long, text string")
    got = rows(repeats.remove_repeats(df, length=34, token=12, sorted_blocks=sorted_blocks))
    assert got == sorted(brute.repeats(plain, 34), key=repr)


# -- 2: shards ------------------------------------------------------------------------

def test_shards_are_even_and_keep_groups(odd, documents):
    for table, plain in ((odd, ODD), documents):
        got = sharding.shard_documents(table).collect()
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
            (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in plain if i is not None)
        by = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(8)}
        sizes = [len(x) for x in by.values()]
        assert max(sizes) - min(sizes) <= 1 and all(x == list(range(len(x))) for x in by.values())
        assert {r["law"] for r in got} == {"rows"} and all(r["grown_shard"] is None for r in got)
    groups = {}
    text = dict(documents[1])
    for r in got:
        groups.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert all(len(shards) == 1 for shards in groups.values())


def test_a_group_larger_than_a_shard_is_split_and_others_are_not(spark):
    plain = [(i, "hot" if i < 400 else f"pair {i // 2}") for i in range(1000)]
    got = sharding.shard_documents(spark.createDataFrame(plain, "doc_id long, text string")).collect()
    sizes = np.bincount([r["shard"] for r in got], minlength=8)
    assert list(sizes) == [125] * 8
    of = {r["doc_id"]: r["shard"] for r in got}
    assert sum(of[i] != of[i + 1] for i in range(400, 1000, 2)) <= 30


# -- 3: packing ----------------------------------------------------------------------------

ODD_TEXTS = [None, "", " ", "\n", "  a  b \n\n c ", "x <|endoftext|> y<|endoftext|>\n", "\t\ttab  ", "don't we'll  \r\n x",
             "　", "a \x1c b\x1d", "日本 語 ", "a\x85b", "ab" * 3000, "a\xa0 b", " lead", "trail ", "nul\x00byte"]


def test_ids_are_those_of_the_tokenizer(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ODD_TEXTS + [t for _, t in documents[1][:60]]
    got = dict(packing.Encoder(*queries.vocabulary()).texts(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        assert list(got[i]) == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_packing_is_a_round_trip(documents, odd):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for table, plain in (documents, (odd, ODD)):
        want = sorted(zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")[a:a + 2048]
                                 .tobytes())
                      for _, t in plain
                      for a in range(0, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1, 2048))
        got = packing.pack_documents(table, *queries.vocabulary()).collect()
        assert sorted(r["ids_crc32"] for r in got) == want
        by = {}
        for r in got:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in by.values():
            pieces.sort()
            assert pieces[0][0] == 0 and sum(n for _, n in pieces) <= 2048
            assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))


def test_patterns_cover_the_demand_with_little_waste():
    rng = np.random.default_rng(5)
    sizes = np.minimum(256, 1 + rng.exponential(70, 20_000).astype(int))
    demand = {int(u): int(n) for u, n in zip(*np.unique(sizes, return_counts=True))}
    cut = packing.cutting_patterns(demand)
    covered = {}
    for times, pattern in cut:
        assert sum(u * n for u, n in pattern.items()) <= packing.UNITS
        for u, n in pattern.items():
            covered[u] = covered.get(u, 0) + times * n
    assert covered == demand and packing.cutting_patterns({}) == []
    assert sum(t for t, _ in cut) * packing.UNITS <= 1.01 * sizes.sum()


# -- 4: toxicity ---------------------------------------------------------------------------

def test_kernel_counts_subsequences():
    def plain(s, t, order=toxicity.ORDER, decay=toxicity.DECAY):
        from itertools import combinations
        return sum(decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
                   for a in combinations(range(len(s)), order) for b in combinations(range(len(t)), order)
                   if all(s[i] == t[j] for i, j in zip(a, b)))

    pairs = [(b"idiot", b"idiot"), (b"id.iot", b"idiot"), (b"iidioott", b"idiot"), (b"table", b"idiot"), (b"idot", b"idiot")]
    for s, t in pairs:
        matrix, sizes = toxicity._matrix([s], len(s) + 2)
        assert toxicity.kernel(matrix, sizes, t)[0] == pytest.approx(plain(s, t), rel=1e-5)
        assert toxicity._self(matrix)[0] == pytest.approx(plain(s, s), rel=1e-5)


def test_gapped_and_spelled_insults_are_found():
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(["the", "river", "stone", "walks", "green", "table"], 12)) for _ in range(120)]
    toxic = [c + (" the idiot walks" if i % 2 else " green moron table") for i, c in enumerate(clean[:60])]
    model = toxicity.fit(clean + toxic, [0] * 120 + [1] * 60)
    texts = ["an idiot here", "an id.iot here", "an i d i o t here", "IDIOT!", "the green river", "", None, "x" * 50_000]
    scores = model.scores(toxicity.Scorer(model.landmarks).features(pa.array(texts, pa.string())))
    assert (scores[:4] >= 0.7).all() and (scores[4:] < 0.7).all()


def test_toxicity_on_held_out_rows(spark, odd):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    got = (toxicity.score_documents(docs, model).join(labels, "doc_id").filter("held_out")
           .groupBy("toxic", "predicted").count().collect())
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    assert n.get((0, 1), 0) <= 1 and n[1, 1] >= n.get((1, 0), 0)
    assert toxicity.score_documents(odd, model).count() == len(ODD)
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    none = toxicity.train(docs, labels.filter("false"))
    assert toxicity.score_documents(docs, none).filter("predicted = 1").isEmpty()


# -- 5: equal texts --------------------------------------------------------------------------

@pytest.mark.parametrize("block", [4096, 64])
def test_exact_dedup_as_by_brute_force(odd, documents, block):
    for table, plain in ((odd, ODD), documents):
        got = exact_dedup.exact_dedup(table, block_bytes=block).collect()
        groups = {}
        for i, t in plain:
            groups.setdefault(brute.fold(t), []).append(i)
        want = []
        for text, ids in groups.items():
            best = max((i for i in ids if i is not None), default=None)
            sha = hashlib.sha256(text.encode()).hexdigest()
            spent = False
            for i in ids:
                kept = i == best and not spent
                spent = spent or kept
                want.append((i, best, len(ids), kept, sha))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_dropping_copies_keeps_whole_rows(odd):
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(brute.fold(r["text"]) for r in left.collect()) == sorted({brute.fold(t) for _, t in ODD})


# -- 6: near copies ------------------------------------------------------------------------

def test_jaccard_as_by_brute_force(documents, odd, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 3)
    for table, plain in (documents, (odd.filter("doc_id is not null"), [x for x in ODD if x[0] is not None])):
        assert rows(jaccard.near_duplicates(table)) == sorted(set_by_text(brute.jaccard(plain), plain), key=repr)


def set_by_text(found, plain):
    return [tuple(r) for r in found] if plain else []


def test_tree_walk_links_what_all_pairs_link():
    rng = np.random.default_rng(2)
    for _ in range(20):
        seeds = [rng.integers(0, 1 << 62, 60).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(50):
            seed = seeds[rng.integers(4)]
            own = np.concatenate([seed[rng.random(60) > rng.random() * 0.3],
                                  rng.integers(0, 1 << 62, rng.integers(0, 12)).astype(np.uint64)])
            sets.append(np.unique(own))
        for split in (None, 20):
            pairs = [(i, j) for i in range(50) for j in range(i + 1, 50) if split is None or i < split <= j]
            want = [(i, j) for i, j in pairs
                    if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
            assert parts(want, 50) == parts(jaccard.links(sets, split), 50)


def parts(edges, n):
    root = list(range(n))
    for a, b in edges:
        ra, rb = root[a], root[b]
        root = [ra if r == rb else r for r in root]
    return {frozenset(i for i in range(n) if root[i] == r) for r in root}


def test_dropping_near_copies_keeps_one_of_each_group(odd):
    left = jaccard.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left.collect())
    # 3, 4 and 5 have no words and stay; the rows without an id are one group.
    want = {c for _, _, c in brute.jaccard([x for x in ODD if x[0] is not None])}
    assert {3, 4, 5, 9, 10} <= want and got == sorted([(False, i) for i in want] + [(True, 0)])


def test_frequent_shingles_of_a_large_table_do_not_chain_it(spark, monkeypatch):
    """A passage of some texts is seen as frequent however small its share of a large table is, so these texts are no cluster."""
    rng = np.random.default_rng(5)
    passages = [" ".join(f"p{rng.integers(10 ** 9)}" for _ in range(12)) for _ in range(20)]
    texts = [" ".join(f"w{rng.integers(10 ** 9)}" for _ in range(40)) for _ in range(600)]
    texts = [f"{t} {passages[i % 20]} {passages[(i // 20) % 20]}" for i, t in enumerate(texts)]
    plain = [*enumerate(texts), (600, texts[7] + " more"), (601, texts[8] + " other words")]
    monkeypatch.setattr(jaccard, "SAMPLE_ROWS", 25)
    monkeypatch.setattr(jaccard, "PAIRED", 10)
    written, settle = {}, jaccard.settle

    def counted(df, name):
        out = settle(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "settle", counted)
    found = jaccard.near_duplicates(spark.createDataFrame(plain, "doc_id bigint, text string"))
    assert rows(found) == sorted(set_by_text(brute.jaccard(plain), plain), key=repr)
    assert 4 <= written["members"] < 200


# -- 7: pages: see test_pages.py; 8: benchmark ------------------------------------------------

def test_passages_as_by_brute_force(documents, odd, spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    extra = [(900, "w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20 w21 w22 w23"), (901, "one two three"), (902, "one"),
             (903, None), (904, ""), (905, "w190 w191 w192 w193 w194 w195 w196 w197 w198 w199 w201 w202 w203 w204")]
    for table, plain, bench_, items_ in (
            (*documents, bench, items), (odd.filter("doc_id is not null"), [x for x in ODD if x[0] is not None],
                                         spark.createDataFrame(extra, "item_id long, text string"), extra)):
        got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_passages(table, bench_).collect()}
        want = brute.passages(plain, items_)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)
        clean = decontaminate.drop_contaminated(table, bench_)
        hit = {d for d, _ in want}
        assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in plain} - hit and clean.columns == table.columns
    # In blocks of a few items the same pairs come out.
    small = decontaminate.find_passages(documents[0], bench, item_bytes=1500)
    assert {(r["doc_id"], r["item_id"]) for r in small.collect()} == brute.passages(documents[1], items).keys()


def test_a_document_shorter_than_the_item_is_one_window(spark):
    item = [f"q{i}" for i in range(42)]
    docs = {1: item[:-1], 2: item[1:], 3: item[:20] + item[21:], 4: item[:30], 5: item[:3], 6: item}
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "b c"), (9, " ".join(f"z{i}" for i in range(50)))],
                                  "item_id long, text string")

    def shingles(words):
        return {tuple(words[j:j + 5]) for j in range(len(words) - 4)}

    # All shingles weigh the same here: each is in one item at most.
    want = {i: len(shingles(w) & shingles(item)) / len(shingles(w) | shingles(item)) for i, w in docs.items()}
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in decontaminate.find_passages(table, bench).collect()}
    assert got == {(i, 7): (pytest.approx(a, abs=1e-6), 0) for i, a in want.items() if a >= 0.75}
    assert {i for i, _ in got} == {1, 2, 3, 6}
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(table, bench).collect()} == {4, 5}


def test_blocks_of_items_weigh_alike(spark):
    lead = " ".join(f"lead{i}" for i in range(12))
    items = [(i, f"{lead} " + " ".join(f"own{i}x{j}" for j in range(25))) for i in range(12)]
    docs = [(i, t.replace(f"own{i}x23 ", "other ") + f" and more words {lead}") for i, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    whole = rows(decontaminate.find_passages(table, bench))
    want = brute.passages(docs, items)
    assert {(d, i): pytest.approx(s, abs=1e-6) for d, i, s, *_ in whole} == want and len(want) >= 12
    assert rows(decontaminate.find_passages(table, bench, item_bytes=700)) == whole


def test_recall_of_changed_passages(spark):
    """Items with random words replaced, most of them little above the similarity: nine in ten at least are found."""
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"v{x}" for x in rng.integers(0, 3000, 60))) for i in range(40)]
    docs = []
    for i, text in items:
        for copy, changes in enumerate((0, 1, 1, 2)):
            held = text.split()
            for at in rng.choice([*range(3), *range(57, 60)], changes, replace=False) if copy % 2 else rng.choice(60, changes):
                held[int(at)] = "changed"
            docs.append((10 * i + copy, "some words before " + " ".join(held) + " and some after"))
    want = brute.passages(docs, items)
    assert sum(0.75 <= s < 0.9 for s in want.values()) >= 20
    got = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got.collect()}
    assert found.keys() <= want.keys() and len(found) >= 0.9 * len(want)
    assert all(found[k] == pytest.approx(want[k], abs=0.2) for k in found)


def test_blocks_find_every_fingerprint_in_the_radius():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, decontaminate.RADIUS, replace=False):
            b ^= 1 << int(bit)
        assert any(((a >> s) & 255) in decontaminate._NEAR_BYTES[(b >> s) & 255] for s in range(0, 64, 8))


# -- 9: chats --------------------------------------------------------------------------------

def test_chats_that_prefix_longer_ones_go(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"),
             (2, 2, "user", "more"), (3, 5, "user", "hi"), (4, 0, "user", "hi"), (4, 1, "assistant", "yes"),
             (4, 2, "user", "more"), (5, 0, None, None), (6, 0, "unknown", ""), (None, 0, "user", "lost"),
             (7, 0, "user", "a"), (7, 0, "user", "a"), (8, 0, "user", "a")]
    turns += [(9, i, "user", f"t{i}") for i in range(600)] + [(10, i, "user", f"t{i}") for i in range(300)]
    df = spark.createDataFrame([t + ("x", 1) for t in turns],
                               "conv_id long, turn long, role string, text string, key string, pos int")
    got = {}
    for r in df.transform(chat.format_chats).orderBy("part").collect():
        got.setdefault(r["conv_id"], []).append(r)
    assert set(got) == {2, 5, 6, None, 7, 9}
    assert got[2][0]["n_copies"] == 2 and got[2][0]["rendered"].count("<|im_start|>") == 3
    assert [r["part"] for r in got[9]] == [0, 1, 2]
    assert "".join(r["rendered"] for r in got[9]) == "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(600))
    assert got[5][0]["rendered"] == got[6][0]["rendered"] == "<|im_start|>unknown\n<|im_end|>\n"


# -- 10: language model ----------------------------------------------------------------------

def test_base_scores_as_by_brute_force(documents, odd):
    got = lm.score_documents(documents[0], *queries.vocabulary(), steps=20, block_bytes=100_000).collect()
    want = brute.lm_base(documents[1])
    for r in got:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and np.isfinite(r["score"])
    strange = lm.score_documents(odd, *queries.vocabulary(), steps=5).collect()
    assert len(strange) == len(ODD) and all(np.isfinite(r["score"]) for r in strange)


def test_all_training_rows_teach_the_network(spark, monkeypatch):
    # The one row that the common start sees has other words than all the rest.
    ids = spark.range(1200).select(F.col("id").alias("doc_id"))
    first = ids.filter(~lm.held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").first()[0]
    docs = ids.withColumn("text", F.when(F.col("doc_id") == first, "a stone").otherwise(F.repeat(F.lit("red green blue "), 100)))
    got = lm.score_documents(docs, *queries.vocabulary(), sample_rows=1, steps=1, block_bytes=400_000).collect()
    # Counts alone give a third for each word: -0.48.
    each = [r["score"] / r["n_tokens"] for r in got if r["held_out"]]
    assert len(each) > 100 and min(each) > -0.2
    # Any fan gives the mean by subwords seen.
    start = lm.untrained(np.zeros(lm.IDS), np.arange(lm.IDS) % lm.CLASSES)
    flats = [lm._packed(start) * np.float32(k) for k in range(1, 6)]
    nets = spark.createDataFrame([(k, k + 1, bytearray(f.tobytes()), bytearray(np.full(lm.CLASSES, k, "<i8").tobytes()))
                                  for k, f in enumerate(flats)], lm.NETS)
    monkeypatch.setattr(lm, "FAN", 2)
    mean, mass = lm._average(nets, 5, start)
    assert np.allclose(lm._packed(mean), lm._packed(start) * (55 / 15), atol=1e-4)
    assert mass.tolist() == [10] * lm.CLASSES


def test_held_out_rows_score_above_their_base(documents):
    """The context tells more than counts alone do."""
    held = [r for r in lm.score_documents(documents[0], *queries.vocabulary(), block_bytes=200_000).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
    assert sum(r["score"] > r["base_score"] for r in held) > 0.8 * len(held)


def test_windows_lie_evenly_in_all_texts(monkeypatch):
    """Each text trains the network with one window in EVERY, and with one at least."""
    chosen = []
    monkeypatch.setattr(lm, "_descend", lambda net, texts, batches: chosen.extend(np.concatenate(batches).tolist()))
    sizes = [1, 5, 16, 17, 100, 1000, 1000, 1000, 1000]
    assert lm.train_on(None, [np.zeros(n, dtype=int) for n in sizes]) == sum(sizes)
    starts = np.cumsum(sizes) - sizes
    per_text = [[c - a for c in chosen if a <= c < a + n] for a, n in zip(starts, sizes)]
    assert [len(x) for x in per_text[:5]] == [1, 1, 1, 1, 2] and all(len(x) in (15, 16) for x in per_text[5:])
    assert {x % (lm.HALF * lm.EVERY) for t in per_text[5:] for x in t} == {lm.HALF * k for k in range(lm.EVERY)}


def test_a_block_trains_on_all_windows(monkeypatch):
    """Every token of the training rows of a block is the target of a window, and none of the other rows is."""
    seen = []

    def descend(net, texts, batches):
        length = sum(map(len, texts))
        seen.append((length, sorted(p for a in np.concatenate(batches).tolist() for p in range(a, a + lm.HALF) if p < length)))

    monkeypatch.setattr(lm, "_descend", descend)
    counts = np.ones(lm.IDS)
    net = lm.untrained(counts, np.arange(lm.IDS) % lm.CLASSES)
    learn = lm._learner(type("Shared", (), {"value": net}), *queries.vocabulary())
    learn(pa.table({"block": pa.array([0] * 3), "id": pa.array([1, 2, 3]), "held": pa.array([False, False, True]),
                    "text": pa.array(["one two three " * 60, "a b", "not seen " * 50])}))
    (length, places), = seen
    assert length == 184 and set(places) == set(range(length))


def test_first_subwords_are_those_of_the_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    leads = lm.Leads(*queries.vocabulary())
    for _ in range(2):
        for words_ in (["hello", "wörld", "x" * 70, "don't", "4711", "."], ["hello", "new", "a\u00a0b"]):
            chunk = next(tokens.words(pa.array([" ".join(words_)])))
            which, _, lead = lm._sequences(chunk, leads)
            assert lead[which].tolist() == [tokenizer.encode(" " + w, add_special_tokens=False).ids[0] for w in words_]


def test_words_of_a_block_are_not_encoded_again_in_the_next(monkeypatch):
    """Blocks that a process works on one after the other share the first subwords of their words."""
    encoded = []
    whole = packing.Encoder.whole
    monkeypatch.setattr(packing.Encoder, "whole", lambda self, text: (encoded.append(text), whole(self, text))[1])
    net = lm.untrained(np.ones(lm.IDS), np.arange(lm.IDS) % lm.CLASSES)
    calls = []
    for block in range(2):
        learn = lm._learner(type("Shared", (), {"value": net}), *queries.vocabulary())
        learn(pa.table({"block": pa.array([block]), "id": pa.array([block]), "held": pa.array([False]),
                        "text": pa.array(["aqbvcx bqcvdx cqdvex"])}))
        calls.append(len(encoded))
    assert calls == [1, 1]
    assert sorted(encoded[0].split()) == [b"aqbvcx", b"bqcvdx", b"cqdvex"]


def test_attention_scores_each_id_once_and_only_looks_back():
    rng = np.random.default_rng(0)
    texts = [np.append(rng.integers(0, 40, n), lm.END) for n in (1, 15, 16, 17, 100)]
    net = lm.train_network(texts, steps=30)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = net.score(np.concatenate(texts), first)
    for t, a, b in zip(texts, first[:-1], first[1:]):
        assert np.allclose(net.score(t, np.array([0, len(t)])), whole[a:b], atol=1e-4)
    assert set(net.class_of) == set(range(lm.CLASSES))
    changed = texts[-1].copy()
    changed[60] = 3 if changed[60] != 3 else 4
    again = net.score(changed, np.array([0, len(changed)]))
    assert np.allclose(again[:60], whole[first[-2]:first[-2] + 60], atol=1e-5)


# -- all ---------------------------------------------------------------------------------------

def test_empty_tables(spark):
    docs = spark.createDataFrame([], EMPTY)
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    for df in (repeats.remove_repeats(docs), sharding.shard_documents(docs),
               packing.pack_documents(docs, *queries.vocabulary()), toxicity.score_documents(docs, model),
               exact_dedup.exact_dedup(docs), jaccard.near_duplicates(docs), decontaminate.find_passages(docs, items),
               chat.format_chats(turns), exact_dedup.drop_duplicates(docs), jaccard.drop_near_duplicates(docs),
               lm.score_documents(docs, *queries.vocabulary(), steps=1)):
        assert df.count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(chain, "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 301)}, 1000: 1000, 1001: 1000}


def test_ranks_in_groups(spark):
    df = settle(spark.range(5000).withColumn("g", F.col("id") % 3).withColumn("h", F.xxhash64("id")), "ranks")
    got = rank_in_groups(df, ["g"], "h", ["id"], "rank", 100_000).collect()
    for g in range(3):
        ranked = sorted((r["rank"], r["h"]) for r in got if r["g"] == g)
        assert [a for a, _ in ranked] == list(range(len(ranked)))
        assert [h for _, h in ranked] == sorted(h for _, h in ranked)


def test_words_are_cut_alike():
    texts = [None, "", "a", " a", "A b\x0bc\n", "é　x y", "end", "Next start"]
    got = {}
    for chunk in tokens.words(pa.array(texts, pa.string())):
        for row, a, b in zip(chunk.rows, chunk.first[:-1], chunk.first[1:]):
            got[row] = [chunk.data[s:e].tobytes().decode() for s, e in zip(chunk.starts[a:b], chunk.ends[a:b])]
    assert got == {i: brute.words(t) for i, t in enumerate(texts)}
