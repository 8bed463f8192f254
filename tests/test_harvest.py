"""Adapters and providers over recorded replies."""

import datetime as dt
import json

import pytest

from turnstone.operators import providers
from turnstone.sources import harvest, http, store


class Recorded:
    """A transport that knows some addresses; lists are given one after the other."""

    def __init__(self, replies):
        self.replies, self.calls = replies, []

    def __call__(self, call):
        self.calls.append(call)
        reply = self.replies.get(call.url, http.Reply(404))
        if isinstance(reply, list):
            reply = reply.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return reply


def client(replies):
    waits = []
    recorded = Recorded(replies)
    made = http.Client(recorded, wait=waits.append)
    made.waits = waits
    return made


def ok(body):
    return http.Reply(200, body if isinstance(body, bytes) else json.dumps(body).encode())


SPAN = dt.date(2024, 12, 1), dt.date(2025, 3, 31)


def test_retries_and_errors():
    c = client({"u": [http.TransportError("down"), http.Reply(503), http.Reply(429), ok({"a": 1})]})
    assert c.get("u").json() == {"a": 1} and c.waits == [1.0, 2.0, 4.0]
    with pytest.raises(http.StatusError):
        client({"u": [http.Reply(500)] * 4}).get("u")
    assert client({}).get("u").status == 404


def test_daily_extracts(tmp_path):
    base = harvest.Wa.base
    toc = {"proceedings": [{"subjects": [{"index": 2}, {"index": 1}, {"name": "x"}]}, {"subjects": [{"index": 2}]}]}
    day = f"{base}/hansard/lh/2025-02-04"
    c = client({
        f"{base}/hansard/events/2025": ok({"events": [{"date": "2025-02-04", "houseCode": "LH"}, {"date": "2025-02-05", "houseCode": "lh"}, {"date": "2025-06-01", "houseCode": "lh"}]}),
        f"{day}/toc": ok(toc), f"{day}/subject/1?contentType=text%2Fxml": ok(b"<one/>"), f"{day}/subject/2?contentType=text%2Fxml": http.Reply(400),
    })
    adapter, raw = harvest.Wa(c), store.RawStore(tmp_path)
    assert store.harvest(raw, adapter, *SPAN) == 1  # the other day has no table of contents yet
    folder = raw.day("wa", "2025-02-04", "lh")
    assert {p.name for p in folder.iterdir()} == {"toc.json", "subject_0001.xml", "meta.json"} and not raw.day("wa", "2025-02-05", "lh").exists()
    assert store.harvest(raw, adapter, *SPAN) == 0


def test_nsw():
    base = harvest.Nsw.base
    toc = b'<toc><topic ref="7" uid="HANSARD-7"/><topic ref="3" uid="HANSARD-3"/><topic ref="" uid="x"/></toc>'
    c = client({
        f"{base}/year/2025": ok([{"date": "2025-02-11", "Events": [{"TocDocId": "T1", "Chamber": "Legislative Council"}, {"Chamber": "Legislative Assembly"}]}]),
        f"{base}/daily/tableofcontents/T1": ok(toc), f"{base}/daily/fragment/HANSARD-3": ok(b"<a/>"), f"{base}/daily/fragment/HANSARD-7": ok(b"<b/>"),
    })
    adapter = harvest.Nsw(c)
    (event,) = adapter.discover(*SPAN)
    assert (event["date"], event["house"]) == ("2025-02-11", "lc")
    assert [n for n, _ in adapter.fetch(event)] == ["toc.xml", "subject_0003_HANSARD-3.xml", "subject_0007_HANSARD-7.xml"]


def test_federal_links_of_three_ages():
    link = '<a href="/x/Hansard_Display?bid=chamber/hansardr/{}/&amp;sid=0000"{}>{}</a>'
    page = link.format("11", ' aria-label="06-Feb-2025, proof"', 6) + '<a name="2014"></a><p> March </p>' + link.format("12", "", 4) + link.format("13", "", 31) + "<p>June</p>" + link.format("14", "", 31) + 'q=Id%3A%22chamber/hansardr/2004-05-11/0000%22'
    adapter = harvest.Federal(client({harvest.Federal.CALENDARS["reps"]: ok(page.encode())}))
    found = {e["date"]: e for e in adapter.discover(dt.date(2000, 1, 1), dt.date(2026, 1, 1))}
    assert sorted(found) == ["2004-05-11", "2014-03-04", "2014-03-31", "2025-02-06"]  # 31 June isn't a day
    assert found["2025-02-06"]["url"].startswith("https://www.aph.gov.au/api/hansard/link/?id=chamber/hansardr/11/toc")
    assert list(adapter.fetch(found["2025-02-06"])) == []


def test_registry():
    assert set(store.all_adapters()) >= {"wa", "sa", "nsw", "au", "nz", "scot"}
    with pytest.raises(NotImplementedError):
        store.get_adapter("nz").discover(*SPAN)


def test_providers():
    with pytest.raises(providers.ProviderError):
        providers.resolve(None, {})
    with pytest.raises(providers.ProviderError):
        providers.resolve("nobody", {})
    custom = providers.resolve(None, {"TURNSTONE_BASE_URL": "http://x/v1", "TURNSTONE_EMBED_MODEL": "m", "TURNSTONE_CHAT_MODEL": "c", "TURNSTONE_API_KEY": "k"})
    reply = ok({"data": [{"index": 1, "embedding": [2.0]}, {"index": 0, "embedding": [1.0]}]})
    c = client({"http://x/v1/embeddings": [http.Reply(503), reply], "http://x/v1/chat/completions": ok({"choices": [{"message": {"content": "trade"}}]})})
    assert providers.embedder(custom, lambda: c)(["a", "b"]) == [[1.0], [2.0]] and c.transport.calls[-1].headers["Authorization"] == "Bearer k"
    assert providers.completer(custom, lambda: c)("?") == "trade" and json.loads(c.transport.calls[-1].body)["temperature"] == 0
    with pytest.raises(providers.ProviderError):
        providers.embedder(custom, lambda: client({}))(["a"])
    assert len(providers.embedder(providers.resolve("hashing", {}))(["one two"])[0]) == 64
