"""Quality rules, mixing, decontamination, repeats, licenses, tokens, the classifier and pages."""

import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from turnstone.llm import mixing, quality_model, quality_rules, token_output

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    text = text or ""
    w = SPLIT.findall(text)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_base_and_columns(docs):
    got = quality_rules.quality_rules(docs, min_rows=5)
    assert got.columns == [*docs.columns, "_quality"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        q = r["_quality"]
        want = base_of(r.text)
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (q.base_failed and q.kept)
    by_text = {r.text: r["_quality"].kept for r in rows}
    assert not by_text["### $$$ % & | < > x y z w v u"] and not by_text["SHOUT!! LOUD!! " * 30]


def test_sketch_buckets(spark):
    rows = spark.range(0, 70000, 7).select("id", quality_rules.bucket(F.col("id")).alias("b")).collect()
    assert all(r.b <= r.id and (r.id - r.b) * 64 <= max(r.id, 63) for r in rows)
    assert all(r.b == r.id for r in rows if r.id < 128)


def test_quality_empty(empty):
    assert quality_rules.quality_rules(empty).count() == 0


def test_mixing_copies(docs):
    domain = F.lit("d0")
    got = mixing.mix_sources(docs, domain, {"lang": {"en": 3}}, budget_permille=500, epochs=2)
    assert got.columns == [*docs.columns, "_mix"]
    rows = got.collect()
    assert len(rows) == docs.count()
    total = sum(r["_mix"].tokens for r in rows)
    taken = sum(r["_mix"].tokens * r["_mix"].copies for r in rows)
    longest = max(r["_mix"].tokens for r in rows)
    assert 0 <= max(r["_mix"].copies for r in rows) <= 2
    assert abs(taken - total / 2) <= 9 * longest
    all_of_it = mixing.mix_sources(docs, domain, {}, budget_permille=1000, epochs=1).collect()
    assert all(r["_mix"].copies == 1 for r in all_of_it if r["_mix"].tokens)


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "en", "s1", 10), ("a", "de", "s1", 1000), ("b", "en", "s1", 1000)], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(leaves, F.expr("all_tokens * 400 div 1000"), {}, 1).collect()}
    assert got == {("a", "en"): 10, ("a", "de"): 392, ("b", "en"): 402}


def test_mixing_empty(empty):
    assert mixing.mix_sources(empty, F.lit("d"), {}).count() == 0


def test_tokens_round_trip(spark, docs, empty, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = [(100, "á ́b\x1cc d\x85e f"), (101, "<|endoftext|> x <|startoftext|>y"), (102, "Don't I'LL 12345 ΣΑΣ ß İ")]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    token_output.write_tokens(every, str(tmp_path / "t"), path, shard_docs=7)
    got = token_output.read_tokens(spark, str(tmp_path / "t"), with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    encode = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: -1 if d is None else d)
    text = {r.doc_id: r.text for r in every.collect()}
    at = 0
    for r in got:
        ids = encode(text[r.doc_id])
        assert (r.start, r.n_tokens, r.ids, r.ids_crc32) == (at, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    token_output.write_tokens(empty, str(tmp_path / "e"), path)
    assert token_output.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_classifier_on_labels(spark, docs, empty):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    scored = quality_model.classify_quality(read("documents")).join(read("labels"), "doc_id").toPandas()
    good, bad = scored[scored.quality == 1], scored[scored.quality == 0]
    assert good.kept.mean() > 0.98 and bad.kept.mean() < 0.15
    rows = quality_model.classify_quality(docs).collect()
    assert len(rows) == docs.count() and not any(r.kept for r in rows if r.n_words == 0)
    assert quality_model.classify_quality(empty).count() == 0


def test_em_recovers_labellers():
    """Accuracies of independent labellers, drawn at random, and the posterior's labels."""
    r = np.random.default_rng(6)
    k, n = len(quality_model.LABELLERS), 60_000
    good = r.random(n) < 0.7
    hit = r.uniform(0.55, 0.9, k)
    false = r.uniform(0.01, 0.1, k)
    votes = (r.random((n, k)) < np.where(good[:, None], false, hit)).astype(np.int64)
    patterns, back, counts = np.unique(quality_model.pattern_of(votes), return_inverse=True, return_counts=True)
    share, prior, posterior = quality_model.fit_labellers(patterns, counts.astype(float))
    assert abs(prior - 0.7) < 0.02 and np.abs(share[0, :, 1] - hit).max() < 0.03 and np.abs(share[1, :, 1] - false).max() < 0.02
    assert ((posterior[back] > 0.5) == good).mean() > 0.98


def test_scorer_learns_the_posterior():
    """The same texts under opposite labels give opposite scores."""
    import pyarrow as pa

    found = quality_model.Measured(pa.array([f"alpha beta gamma delta {i} words." for i in range(40)] + [f"### $$$ zzz{i} %%% &&&" for i in range(40)]))
    labels = np.repeat([1.0, 0.0], 40)
    score = lambda y: np.bincount(found.owner, quality_model.fit_scorer(found.rows(), y)[found.bins] * found.values, 80)
    assert ((score(labels) > 0) == (labels > 0.5)).all() and ((score(1 - labels) > 0) == (labels < 0.5)).all()


def test_classifier_ties_and_repeated_rows(spark):
    rows = [(1, "same words here every time"), (1, "same words here every time"), (2, "same words here every time"), (None, None), (3, "")]
    got = quality_model.classify_quality(spark.createDataFrame(rows, "doc_id long, text string"), sample_docs=2).collect()
    assert len(got) == 5 and len({r.score for r in got if r.n_words}) == 1 and all(r.score == 0 and not r.kept for r in got if not r.n_words)


def test_every_packaged_tokenizer():
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    import random

    r = random.Random(3)
    pool = [*"aAbHZ.,'’sŚ̱ßİΣσéÉ \t\n\x0b\x1c\x85 <|>12٣\x01", "<|endoftext|>", "'s", "'LL", "The "]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(5000)] + [None]
    for name, by_word in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        encoder, plain = token_output.Encoder(path), Tokenizer.from_file(path)
        encoder.LIMIT = 300
        assert encoder.by_word == by_word
        got = [x for i in range(0, len(texts), 500) for x in encoder.encode_all(pa.array(texts[i : i + 500], pa.string()))]
        assert got == [np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts]
