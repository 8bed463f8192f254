"""Search, its HTTP interface, the tool protocol, indexes and enrichment runs."""

import io
import json

import pytest
from pyspark.sql import functions as F

from turnstone import serve
from turnstone.operators import enrich, pipeline
from turnstone.sources import http, tables, vector_index
from turnstone.sources.schemas import TABLES


class Database:
    """A small vector database behind the REST interface."""

    def __init__(self):
        self.dim, self.points, self.calls = None, {}, []

    def __call__(self, call):
        path = call.url.split("/collections/")[1].split("?")[0].split("/", 1)
        body = json.loads(call.body) if call.body else {}
        self.calls.append((call.method, "/".join(path[1:])))
        reply = lambda x: http.Reply(200, json.dumps({"result": x}).encode())
        if len(path) == 1:
            if call.method == "PUT":
                self.dim = body["vectors"]["size"]
            return reply({"config": {"params": {"vectors": {"size": self.dim}}}}) if self.dim else http.Reply(404)
        if path[1] == "points":
            self.points |= {p["id"]: p for p in body["points"]}
        elif path[1] == "points/delete":
            for i in body["points"]:
                del self.points[i]
        elif path[1] == "points/scroll":
            ids = sorted(self.points)
            at = ids.index(body["offset"]) if "offset" in body else 0
            page = ids[at : at + body["limit"]]
            return reply({"points": [{"id": i} for i in page], "next_page_offset": ids[at + body["limit"]] if at + body["limit"] < len(ids) else None})
        elif path[1] == "points/search":
            dot = lambda p: sum(a * b for a, b in zip(p["vector"], body["vector"], strict=True))
            hits = sorted(self.points.values(), key=lambda p: -dot(p))[: body["limit"]]
            return reply([{"id": p["id"], "score": dot(p), "payload": p["payload"]} for p in hits])
        return reply(None)


def rest(database):
    return vector_index.RestIndex("http://db", "c", lambda: http.Client(database, wait=lambda s: None))


def test_rest_index_and_prune(spark):
    database = Database()
    index = rest(database)
    assert not index.exists() and index.ensure(2) and not index.ensure(2) and index.exists()
    with pytest.raises(vector_index.DimensionError):
        index.ensure(3)
    index.upsert([{"id": f"p{i}", "vector": [i, 1.0], "payload": {"jurisdiction": "wa"}} for i in range(5)])
    assert [p for page in index.ids(page=2) for p in page] == [f"p{i}" for i in range(5)]
    assert [h["id"] for h in index.search([1.0, 0.0], 2)] == ["p4", "p3"]
    kept = spark.createDataFrame([("p1",), ("p3",)], "text_id string")
    assert vector_index.prune(index, kept) == 3 and sorted(database.points) == ["p1", "p3"]


HITS = [
    {"id": "a", "score": 0.9, "payload": {"jurisdiction": "wa", "source_url": "https://x/api/hansard/lh/2025-01-01/toc", "extract_index": 4}},
    {"id": "b", "score": 0.8, "payload": {"jurisdiction": "nsw", "speaker": "Ann", "talker_kind": "interjection", "source_url": "https://x/daily/HANSARD-1", "subject_uid": "HANSARD-1-2"}},
    {"id": "c", "score": 0.7, "payload": {"jurisdiction": "au", "speaker": "Bo", "talker_kind": "speech", "source_url": "https://x/?id=chamber/hansardr/11/toc&linktype=xml"}},
]


class Fixed:
    name = "fixed"

    def exists(self):
        return True

    def search(self, vector, k, jurisdiction=None):
        self.asked = k
        return HITS[:k]


def test_search_ranks_and_links():
    index = Fixed()
    service = serve.SearchService(index, enrich.hashing_embedder(8), "m")
    got = service.search("water", 2)
    assert [h["text_id"] for h in got] == ["c", "b"] and index.asked == 40
    assert [h["text_id"] for h in service.search("water", 3, rank="score")] == ["a", "b", "c"]
    links = {h["text_id"]: h["official_url"] for h in service.search("water", 3)}
    assert links["a"] == "https://x/daily/lh/2025-01-01/4" and links["b"].endswith("?id=HANSARD-1&section=HANSARD-1-2") and links["c"].endswith("bid=chamber/hansardr/11/&sid=0000")
    assert serve.permalink({"jurisdiction": "wa", "source_url": "http://else"}) == "http://else" and serve.permalink({}) is None
    assert set(got[0]) == set(service.contract()["fields"]) and len(got[0]) == 25
    for bad in ({"q": " "}, {"q": "x" * 501}, {"q": "x", "jurisdiction": "zz"}, {"q": "x", "rank": "best"}):
        with pytest.raises(ValueError):
            service.search(**bad)


def test_http_interface():
    service = serve.SearchService(Fixed(), enrich.hashing_embedder(8), "m")

    def get(path, query="", service=service):
        said = []
        body = b"".join(serve.app(service)({"PATH_INFO": path, "QUERY_STRING": query}, lambda status, headers: said.append(status)))
        return said[0][:3], body

    assert get("/healthz")[1] == b'{"status": "ok"}' and json.loads(get("/contract")[1])["embedding_model"] == "m" and get("/")[0] == "200" and get("/none")[0] == "404"
    status, body = get("/search", "q=water&k=1")
    assert status == "200" and len(json.loads(body)["hits"]) == 1
    assert get("/search", "q=")[0] == get("/search", "q=x&k=99")[0] == get("/search", "q=x&k=many")[0] == "422"

    def broken(texts):
        raise http.TransportError("down")

    assert get("/search", "q=x", serve.SearchService(Fixed(), broken, "m"))[0] == "503"


def test_tools(spark):
    frames = {"talks": spark.createDataFrame([(i, "wa", "2025-01-01", "lh") for i in range(3)], "n int, jurisdiction string, date string, house string")}
    tools = serve.Tools(spark, frames, lambda q, k, j: [{"score": 0.12345, "text": q}])
    calls = [
        {"id": 1, "method": "initialize"}, {"method": "notifications/initialized"}, {"id": 2, "method": "tools/list"}, {"id": 3, "method": "tools/call", "params": {"name": "query", "arguments": {"sql": "select n from talks order by n", "limit": 2}}},
        {"id": 4, "method": "tools/call", "params": {"name": "query", "arguments": {"sql": "drop table talks"}}}, {"id": 5, "method": "tools/call", "params": {"name": "semantic_search", "arguments": {"query": "x"}}},
        {"id": 6, "method": "tools/call", "params": {"name": "pipeline_status"}}, {"id": 7, "method": "tools/call", "params": {"name": "table_schema", "arguments": {"table": "talks"}}}, {"id": 8, "method": "else"}, {"id": 9, "method": "tools/call", "params": {"name": "query"}},
    ]
    out = io.StringIO()
    serve.serve_tools(tools, [*map(json.dumps, calls), "{", ""], out)
    replies = {r["id"]: r for r in map(json.loads, out.getvalue().splitlines())}
    text = lambda i: replies[i]["result"]["content"][0]["text"]
    assert {t["name"] for t in replies[2]["result"]["tools"]} == {"list_tables", "table_schema", "query", "semantic_search", "pipeline_status"}
    assert text(3).startswith('{"n":0}\n{"n":1}\n... cut') and text(4).startswith("rejected") and '"score": 0.123' in text(5)
    assert json.loads(text(6)) == {"talks": {"wa": {"rows": 3, "days": 1}}} and text(7).startswith("n  int") and replies[8]["error"]["code"] == -32601 and replies[9]["error"]["code"] == -32602 and replies[None]["error"]["code"] == -32700
    assert tools.list_tables() == "talks" and serve.Tools(spark, frames).semantic_search("x").startswith("no provider")


@pytest.fixture(scope="module")
def frames(spark):
    days = [("f1", "wa", "2025-01-01", "lh"), ("f2", "wa", "2025-01-02", "lh")]
    empty = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    make = lambda name, rows: empty[name].unionByName(spark.createDataFrame(rows), allowMissingColumns=True)
    keyed = lambda f, j, d, h, **row: {"fragment_id": f, "jurisdiction": j, "date": d, "house": h} | row
    return empty | {
        "fragments": make("fragments", [keyed(*d, source_url="http://s") for d in days]),
        "subjects": make("subjects", [keyed(*d, subject_id=f"s{i}", name=n) for i, (d, n) in enumerate(zip(days, ("Water", "Roads"), strict=True))]),
        "talkers": make("talkers", [keyed(*days[0], talker_id="k0", name="Ann", kind="speech")]),
        "texts": make("texts", [keyed(*days[0], text_id="t0", subject_id="s0", talker_id="k0", clean_text="dams and rivers of water", document_order=1), keyed(*days[1], text_id="t1", subject_id="s1", clean_text="roads and bridges for cars", document_order=1), keyed(*days[1], text_id="t2", subject_id="s1", clean_text="  ", document_order=2)]),
    }


def test_embed_again_only_what_changed(spark, frames, tmp_path):
    root, embed = str(tmp_path), enrich.hashing_embedder(16)
    assert pipeline.embed_pending(frames, embed, root, "a/b") == 2 and pipeline.embed_pending(frames, embed, root, "a/b") == 0
    revised = frames | {"texts": frames["texts"].withColumn("clean_text", F.when(F.col("text_id") == "t1", "new words").otherwise(F.col("clean_text")))}
    assert pipeline.embed_pending(revised, embed, root, "a/b") == 1
    rows = spark.read.parquet(f"{root}/embeddings")
    assert sorted((r.text_id, r.model_slug, r.dim) for r in rows.collect()) == [("t0", "a-b", 16), ("t1", "a-b", 16)]
    points = pipeline.citations(frames, rows)
    payload = {r.id: json.loads(r.payload) for r in points.collect()}
    assert payload["t0"]["speaker"] == "Ann" and payload["t0"]["subject_name"] == "Water" and "speaker" not in payload["t1"] and "clean_text" not in payload["t0"]
    hits = vector_index.TableIndex(spark, points).search(embed(["dams and rivers of water"])[0], 1, "wa")
    assert hits[0]["id"] == "t0" and hits[0]["score"] > 0.99


def test_classify_and_prune(spark, frames, tmp_path):
    root = str(tmp_path)
    taxonomy = spark.createDataFrame([("en-AU", 1, "water", "Water", "dams rivers water", False), ("roads", 1, "roads", "Roads", "roads bridges cars", False), ("en-AU", 1, "order", "Order", "water roads", True)], "locale string, version int, theme_id string, theme_name string, description string, procedural boolean")
    assert pipeline.classify_pending(frames, taxonomy, root, "hash", embedder=enrich.hashing_embedder(256)) == 2
    assert pipeline.classify_pending(frames, taxonomy, root, "hash", embedder=enrich.hashing_embedder(256)) == 0
    labels = spark.read.parquet(f"{root}/subject_themes")
    assert sorted((r.subject_id, r.theme_id) for r in labels.where("rank = 1").collect()) == [("s0", "water"), ("s1", "roads")]
    assert pipeline.classify_pending(frames, taxonomy, root, "chat", completer=lambda: lambda prompt: "roads, then water" if "Roads" in prompt.split("\n\n")[1] else "none") == 2
    said = spark.read.parquet(f"{root}/subject_themes").where("engine = 'llm'").orderBy("rank").collect()
    assert [(r.subject_id, r.theme_id, r["rank"], r.score) for r in said] == [("s1", "roads", 1, None), ("s1", "water", 2, None)]
    tables.overwrite_partitions(frames["subjects"].where("date = '2025-01-01'"), f"{root}/subjects", ["jurisdiction", "date", "house"])
    gone = pipeline.prune_partitions(spark, f"{root}/subject_themes", f"{root}/subjects")
    assert len(gone) == 2 and {str(r.date) for r in spark.read.parquet(f"{root}/subject_themes").select("date").distinct().collect()} == {"2025-01-01"}
