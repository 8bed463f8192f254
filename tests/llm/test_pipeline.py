"""The pipeline's stages, each against a plain version of its rule, and the registry."""

import zlib

import numpy as np

import corpus_pipeline
from turnstone.llm import queries


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, sf_dir).cache()
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    long_good = [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 30]
    assert len(set(long_good) - kept) <= 0.02 * len(long_good)

    single = stages["near-duplicate removal"](spark, good, sf_dir).cache()
    texts = [tuple(sorted({tuple(w[i : i + 5]) for i in range(len(w) - 4)})) for w in ((r.text.lower().split()) for r in single.collect())]
    assert single.columns == docs.columns and len(set(texts)) == len(texts)

    clean = stages["benchmark decontamination"](spark, single, sf_dir).cache()
    items = [r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    holds = lambda t: any(" ".join(i) in " ".join(t.lower().split()) for i in items)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect() if not holds(r.text)}

    mixed = stages["source mixing"](spark, clean, sf_dir).cache()
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert 0.5 * words(clean) < words(mixed) <= words(clean) and mixed.columns == docs.columns

    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    got = {r.doc_id: r for r in stages["token ids"](spark, mixed, sf_dir).collect()}
    for r in mixed.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == mixed.count()


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    words = " ".join(f"word{i} goes on" for i in range(30)) + "."
    rows = [(1, words, "en", "src0", None), (1, words, "en", "src0", None), (2, words, None, None, 7), (None, words, "de", "src1", 7), (3, None, "en", "src0", 7), (4, "", "en", None, 0), (5, "long " * 50_000, "en", "src0", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = {"quality rules": [1, 1, 2, None], "near-duplicate removal": [1, 1, 3, 4, 5, None], "benchmark decontamination": [1, 1, 2, 3, 4, 5, None]}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir).collect()
        if name in want:
            assert sorted((r.doc_id for r in got), key=str) == sorted(want[name], key=str), name
        if name == "token ids":
            assert len(got) == len(rows) and {r.n_tokens for r in got if r.doc_id in (3, 4)} == {1}
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_registry():
    assert {name.split("_")[0] for name in queries.QUERIES} == {*(f"op{i}" for i in range(1, 11)), "pipeline"}
    assert set(queries.SQL) <= set(queries.QUERIES)
