"""The search service, its HTTP interface, and the tool protocol for agents."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping
from typing import IO
from urllib.parse import parse_qs

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.operators.enrich import MOST_HITS, Embedder, fetch_size
from turnstone.operators.providers import ProviderError
from turnstone.sources import sqltool
from turnstone.sources.http import StatusError, TransportError

#: Limits and names of the service's interface.
MOST_CHARS, RANKINGS = 500, ("speakers", "score")
JURISDICTIONS = ("wa", "sa", "nsw", "au", "nz", "scot")
#: A hit's fields and the payload fields they come from.
HIT = {
    "jurisdiction": "jurisdiction", "date": "date", "house": "house", "subject": "subject_name", "proceeding": "proceeding_name", "subproceeding": "subproceeding_name", "committee": "committee_name", "bills": "bill_names",
    "speaker": "speaker", "party": "party", "party_abbreviation": "party_abbreviation", "electorate": "electorate", "role": "role", "kind": "talker_kind", "text_kind": "text_kind", "page": "page_no", "time": "time_anchor",
    "parliament_num": "parliament_num", "session_num": "session_num", "review_stage": "review_stage", "source_url": "source_url", "subject_id": "subject_id",
}
#: The public page of a hit, by jurisdiction: what its source address and subject must look like, and the page's address.
PERMALINKS: dict[str, tuple[str, str, str]] = {
    "nsw": (r".*/(HANSARD-[^/]+)/?", r"HANSARD-.+", "https://www.parliament.nsw.gov.au/parliamentary-business/hansard/hansard-full-details?id={0}&section={subject_uid}"),
    "wa": (r"(.*)/api/hansard/(.*)toc", "", "{0}/daily/{1}{extract_index}"),
    "sa": (r"(.*)/api/hansard/(.*)toc", "", "{0}/daily/{1}{extract_index}"),
    "au": (r".*[?&]id=(chamber/hansard[rs]/\d+/)toc.*", "", "https://www.aph.gov.au/Parliamentary_Business/Hansard/Hansard_Display?bid={0}&sid=0000"),
}


def permalink(payload: Mapping[str, object]) -> str | None:
    """The official page of a hit, or the address it was harvested from where none is known."""
    source = payload.get("source_url")
    address, subject, page = PERMALINKS.get(str(payload.get("jurisdiction")), ("(?!)", "", ""))
    found = re.fullmatch(address, str(source or ""))
    fields = {k: payload.get(k) for k in ("subject_uid", "extract_index")}
    if not found or (subject and not re.fullmatch(subject, str(fields["subject_uid"] or ""))) or any(f"{{{k}}}" in page and v is None for k, v in fields.items()):
        return source
    return page.format(*found.groups(), **fields)


def tier(payload: Mapping[str, object]) -> int:
    """0: a speech, question or answer; 1: anything else by a speaker; 2: headings and the like."""
    return 0 if payload.get("talker_kind") in ("speech", "question", "answer") else 1 if payload.get("speaker") else 2


class SearchService:
    """Semantic search that returns metadata and links, never prose."""

    def __init__(self, index: object, embedder: Embedder, model: str):
        self.index, self.embedder, self.model = index, embedder, model

    def search(self, q: str, k: int = 10, jurisdiction: str | None = None, rank: str = "speakers") -> list[dict]:
        faults = {
            "the query is empty": not q.strip(),
            f"the query has more than {MOST_CHARS} characters": len(q) > MOST_CHARS,
            f"unknown jurisdiction; there are {', '.join(JURISDICTIONS)}": jurisdiction is not None and jurisdiction not in JURISDICTIONS,
            f"unknown rank; there are {', '.join(RANKINGS)}": rank not in RANKINGS,
        }
        if any(faults.values()):
            raise ValueError("; ".join(text for text, wrong in faults.items() if wrong))
        k = max(1, min(k, MOST_HITS))
        found = self.index.search(self.embedder([q])[0], fetch_size(k) if rank == "speakers" else k, jurisdiction)
        if rank == "speakers":
            found = sorted(found, key=lambda h: (tier(h["payload"]), -h["score"]))
        return [self.hit(h) for h in found[:k]]

    @staticmethod
    def hit(found: dict) -> dict:
        payload = found["payload"]
        return {"score": found["score"], "text_id": str(found["id"]), "official_url": permalink(payload)} | {name: payload.get(key) or ([] if name == "bills" else payload.get(key)) for name, key in HIT.items()}

    def contract(self) -> dict:
        return {"collection": self.index.name, "embedding_model": self.model, "distance": "cosine", "rankings": list(RANKINGS), "most_hits": MOST_HITS, "results": "metadata and links; no prose", "fields": ["score", "text_id", "official_url", *HIT]}

    def health(self) -> dict:
        try:
            return {"status": "ok" if self.index.exists() else "degraded"}
        except (StatusError, TransportError):
            return {"status": "degraded"}


PAGE = """<!doctype html><meta charset=utf-8><title>Search</title><form action=/search><input name=q autofocus><button>Search</button></form>"""


def app(service: SearchService) -> Callable:
    """A WSGI application: ``/search``, ``/healthz``, ``/contract`` and a page with a form."""

    def answer(path: str, query: dict[str, list[str]]) -> tuple[str, object]:
        one = lambda name, default=None: query.get(name, [default])[0]
        if path == "/healthz":
            return "200 OK", service.health()
        if path == "/contract":
            return "200 OK", service.contract()
        if path != "/search":
            return "404 Not Found", {"detail": "no such page"}
        try:
            k = int(one("k", "10"))
            if not 1 <= k <= MOST_HITS:
                raise ValueError(f"k is from 1 to {MOST_HITS}")
            jurisdiction, rank = one("jurisdiction"), one("rank", "speakers")
            hits = service.search(one("q", ""), k, jurisdiction, rank)
        except ValueError as error:
            return "422 Unprocessable Entity", {"detail": str(error)}
        except (ProviderError, StatusError, TransportError) as error:
            return "503 Service Unavailable", {"detail": str(error)}
        return "200 OK", {"k": k, "jurisdiction": jurisdiction, "rank": rank, "hits": hits}

    def call(environ: dict, start: Callable) -> Iterable[bytes]:
        path = environ.get("PATH_INFO", "/")
        if path == "/":
            start("200 OK", [("Content-Type", "text/html; charset=utf-8")])
            return [PAGE.encode()]
        status, body = answer(path, parse_qs(environ.get("QUERY_STRING", "")))
        start(status, [("Content-Type", "application/json")])
        return [json.dumps(body, ensure_ascii=False, default=str).encode()]

    return call


class Tools:
    """What an agent can call: tables, their columns, read-only SQL, search and status."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame], search: Callable[[str, int, str | None], list[dict]] | None = None):
        self.spark, self.frames, self.find = spark, dict(frames), search
        for name, df in self.frames.items():
            df.createOrReplaceTempView(name)

    def list_tables(self) -> str:
        """The names of all tables."""
        return "\n".join(sorted(self.frames))

    def table_schema(self, table: str) -> str:
        """Columns and types of a table."""
        if table not in self.frames:
            return f"there is no table {table!r}; see list_tables"
        return "\n".join(f"{f.name}  {f.dataType.simpleString()}" for f in self.frames[table].schema)

    def query(self, sql: str, limit: int = 100) -> str:
        """One read-only statement; rows as JSON lines, a hundred unless more are asked for."""
        limit = max(1, min(int(limit), sqltool.MOST_ROWS))
        try:
            rows = sqltool.read_only(self.spark, sql, {}).limit(limit + 1).toJSON().collect()
        except Exception as error:  # noqa: BLE001  the agent reads what is wrong with its statement
            return f"rejected: {str(error).splitlines()[0][:300]}"
        more = [f"... cut at {limit} rows; `limit` may be up to {sqltool.MOST_ROWS}"] if len(rows) > limit else []
        return "\n".join([*rows[:limit], *more]) or "(0 rows)"

    def semantic_search(self, query: str, k: int = 10, jurisdiction: str | None = None) -> str:
        """What was said about something, best first, as JSON lines."""
        if self.find is None:
            return "no provider of embeddings is set up"
        try:
            hits = self.find(query, k, jurisdiction)
        except (ProviderError, StatusError, TransportError, ValueError) as error:
            return f"no answer: {error}"
        return "\n".join(json.dumps(h | {"score": round(h["score"], 3)}, ensure_ascii=False, default=str) for h in hits) or "no matches"

    def pipeline_status(self) -> str:
        """Rows and days of each table by jurisdiction, as JSON."""
        return json.dumps(status(self.frames))


def status(frames: Mapping[str, DataFrame]) -> dict:
    """Rows and days of each table by jurisdiction; one row a jurisdiction reaches the driver."""
    out = {}
    for name, df in frames.items():
        if {"jurisdiction", "date", "house"} <= set(df.columns):
            counted = df.groupBy("jurisdiction").agg(F.count("*").alias("rows"), F.countDistinct("date", "house").alias("days"))
            out[name] = {r.jurisdiction: {"rows": r.rows, "days": r.days} for r in counted.collect()}
    return out


def serve_tools(tools: Tools, lines: IO[str], out: IO[str], name: str = "turnstone") -> None:
    """Answer JSON-RPC calls, one a line: initialize, tools/list and tools/call."""
    methods = [tools.list_tables, tools.table_schema, tools.query, tools.semantic_search, tools.pipeline_status]
    kinds = {"str": "string", "int": "integer", "str | None": "string"}

    def described(method: Callable) -> dict:
        hints = {k: v for k, v in method.__annotations__.items() if k != "return"}
        needed = list(hints)[: len(hints) - len(method.__defaults__ or ())]
        return {"name": method.__name__, "description": method.__doc__, "inputSchema": {"type": "object", "properties": {k: {"type": kinds[v]} for k, v in hints.items()}, "required": needed}}

    def result(method: str, params: dict) -> object:
        if method == "initialize":
            return {"protocolVersion": params.get("protocolVersion", "2024-11-05"), "capabilities": {"tools": {}}, "serverInfo": {"name": name, "version": "1"}}
        if method == "tools/list":
            return {"tools": [described(m) for m in methods]}
        if method == "tools/call":
            chosen = {m.__name__: m for m in methods}[params["name"]]
            return {"content": [{"type": "text", "text": chosen(**params.get("arguments", {}))}]}
        if method == "ping":
            return {}
        raise LookupError(method)

    for line in lines:
        if not line.strip():
            continue
        try:
            call = json.loads(line)
        except ValueError:
            reply = {"jsonrpc": "2.0", "id": None, "error": {"code": -32700, "message": "not JSON"}}
        else:
            if "id" not in call:
                continue  # a notification
            reply = {"jsonrpc": "2.0", "id": call["id"]}
            try:
                reply["result"] = result(call.get("method", ""), call.get("params") or {})
            except (LookupError, TypeError) as error:
                reply["error"] = {"code": -32601 if isinstance(error, LookupError) else -32602, "message": str(error)}
        out.write(json.dumps(reply, ensure_ascii=False) + "\n")
        out.flush()
