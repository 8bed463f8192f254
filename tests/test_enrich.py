import datetime as dt

import pytest

from turnstone.operators import enrich
from turnstone.sources import store, vocabulary


def test_freshness_and_orphans(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "p string, i int, t string")
    new = spark.createDataFrame([("a", 1, "x"), ("b", 2, "changed"), ("c", 3, "z")], "p string, i int, t string")
    sign = lambda df: enrich.signatures(df, ["p"], "i", "t")
    assert sorted(r.p for r in enrich.stale(sign(new), sign(old), ["p"]).collect()) == ["b", "c"]
    assert [r.p for r in enrich.orphans(new, old, ["p"]).collect()] == ["c"]


def test_themes_and_embeddings(spark):
    answers = spark.createDataFrame([(1, "tax-law then tax, and tax-law again; health")], "id int, answer string")
    got = [(r.theme_id, r["rank"]) for r in enrich.answered_themes(answers, "id", "answer", ["tax", "tax-law", "health"], 2).collect()]
    assert got == [("tax-law", 1), ("tax", 2)]
    texts = spark.createDataFrame([("a", "one two"), ("b", "  "), ("c", None)], "id string, t string")
    rows = enrich.embed_texts(texts, enrich.hashing_embedder(8), "id", "t").collect()
    assert [(r.id, r.dim) for r in rows] == [("a", 8)] and abs(sum(x * x for x in rows[0].embedding) - 1) < 1e-6
    assert enrich.fetch_size(5) == 40 and enrich.fetch_size(500) == 200


def test_vocabulary(spark):
    rows = vocabulary.stage_table(spark, {"wa": "assent: [' Assent ']\nfirst_reading: [Introduced]"}).collect()
    assert {(r.name_lower, r.stage_order) for r in rows} == {("assent", 13), ("introduced", 1)}
    for bad in ("nonsense: [x]", "assent: [x, X]"):
        with pytest.raises(ValueError):
            vocabulary.stage_rows("wa", bad)
    with pytest.raises(ValueError):
        vocabulary.taxonomy(spark, "locale: en-AU\nversion: 1\nthemes: [{id: a, name: A}, {id: a, name: B}]")
    assert vocabulary.locale_of("scot") == "en-GB" and vocabulary.locale_of("??") == "en-AU"


def test_harvest(tmp_path):
    @store.register
    class Own(store.Adapter):
        jurisdiction = "test"
        days = [{"date": "2025-01-02", "house": "lh"}, {"date": "2025-01-03", "house": "lh"}]

        def discover(self, start, end):
            return self.days

        def fetch(self, event):
            return [("1.xml", b"<x/>")] if event["date"] == "2025-01-02" else []

    raw, adapter = store.RawStore(tmp_path), store.get_adapter("test")
    span = dt.date(2025, 1, 1), dt.date(2025, 1, 5)
    assert store.harvest(raw, adapter, *span) == 1 and store.harvest(raw, adapter, *span) == 0
    assert store.harvest(raw, adapter, *span, refresh_days=9) == 1
    assert [p.parent.name for p in raw.days("test")] == ["2025-01-02"]
    with pytest.raises(NotImplementedError):
        store.get_adapter("nowhere")
