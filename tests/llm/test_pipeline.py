"""The pipeline, each stage against a plain version of it on what the stage before has kept."""

import zlib

import numpy as np
import plain_versions as brute
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF
from wavemeld.llm import toxicity
from wavemeld.llm.common import settle
from wavemeld.llm.queries import table


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_duplicates", "decontamination", "packing"]
    docs = table(spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, plain = docs, [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = settle(stage(spark, docs, SF), name)
        if name == "packing":
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            want = []
            for i, text in plain:
                ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
                want.extend((i, a, zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes())) for a in range(0, len(ids), 2048))
            assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in docs.collect()) == sorted(want)
            break
        assert docs.schema == before.schema
        got = {r["doc_id"] for r in docs.collect()}
        kept.append(len(got))
        if name == "toxicity":
            model = toxicity.train(before, table(spark, SF, "labels"))
            want = {r["doc_id"] for r in toxicity.score_documents(before, model).collect() if r["predicted"] == 0}
        elif name == "exact_dedup":
            want = set({brute.fold(t): i for i, t in sorted(plain)}.values())
        elif name == "near_duplicates":
            want = {c for _, _, c in brute.jaccard(plain)}
        else:
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            want = {i for i, _ in plain} - {d for d, _ in brute.passages(plain, items)}
        assert got == want, name
    assert kept == sorted(kept, reverse=True)
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_rest_stands_without_this_subpackage(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if "llm" in name else find(name, *a))
    assert "op5_exact_dedup" not in entry.queries() and "scan_csv" in entry.queries()
    monkeypatch.undo()
    assert {"pipeline", "op5_exact_dedup", "op10_lm_scoring"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
