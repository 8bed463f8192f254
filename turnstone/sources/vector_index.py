"""Vector indexes: one over the REST interface of a vector database, one over a table."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.operators import vectors

from .http import Client, StatusError

#: Payload fields that searches and scrolls filter by.
FILTERED = ("jurisdiction", "house", "date")
#: Points at which the database starts to build its graph again after a bulk load.
GRAPH_FROM = 20_000


class DimensionError(ValueError):
    """The index was made for vectors of another length."""


class RestIndex:
    """A collection of a vector database that speaks the ``/collections`` REST interface."""

    def __init__(self, url: str, name: str, client: Callable[[], Client] = Client):
        self.base, self.name, self.make = f"{url.rstrip('/')}/collections/{name}", name, client
        self._client: Client | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_client": None}  # each worker connects by itself

    @property
    def client(self) -> Client:
        self._client = self._client or self.make()
        return self._client

    def exists(self) -> bool:
        return self.client.call("GET", self.base).status == 200

    def ensure(self, dim: int) -> bool:
        """Create the collection and its filter indexes if it is missing; whether it was."""
        reply = self.client.call("GET", self.base)
        if reply.status == 200:
            have = reply.json()["result"]["config"]["params"]["vectors"].get("size")
            if have != dim:
                raise DimensionError(f"{self.name} holds vectors of {have} numbers, not {dim}")
            return False
        if reply.status != 404:
            raise StatusError(reply, self.base)
        self.client.must("PUT", self.base, {"vectors": {"size": dim, "distance": "Cosine"}})
        for field in FILTERED:
            self.client.must("PUT", f"{self.base}/index", {"field_name": field, "field_schema": "keyword"}, params={"wait": "false"})
        return True

    def bulk(self, on: bool) -> None:
        """Hold the graph's building back during a bulk load, and let it go on after it."""
        self.client.must("PATCH", self.base, {"optimizers_config": {"indexing_threshold": 0 if on else GRAPH_FROM}})

    def upsert(self, points: Sequence[dict]) -> None:
        self.client.must("PUT", f"{self.base}/points", {"points": list(points)}, params={"wait": "false"})

    def delete(self, ids: Sequence[str]) -> None:
        self.client.must("POST", f"{self.base}/points/delete", {"points": list(ids)}, params={"wait": "true"})

    def ids(self, jurisdiction: str | None = None, page: int = 10_000) -> Iterator[list[str]]:
        """All ids, a page at a time."""
        body: dict = {"limit": page, "with_payload": False, "with_vector": False} | _filter(jurisdiction)
        while True:
            result = self.client.must("POST", f"{self.base}/points/scroll", body)["result"]
            if result["points"]:
                yield [str(p["id"]) for p in result["points"]]
            if result.get("next_page_offset") is None:
                return
            body["offset"] = result["next_page_offset"]

    def search(self, vector: Sequence[float], k: int, jurisdiction: str | None = None) -> list[dict]:
        found = self.client.must("POST", f"{self.base}/points/search", {"vector": list(vector), "limit": k, "with_payload": True} | _filter(jurisdiction))
        return [{"id": str(p["id"]), "score": p["score"], "payload": p.get("payload") or {}} for p in found["result"]]


def _filter(jurisdiction: str | None) -> dict:
    return {"filter": {"must": [{"key": "jurisdiction", "match": {"value": jurisdiction}}]}} if jurisdiction else {}


class TableIndex:
    """The same questions asked of a table (id, embedding, jurisdiction, payload as JSON), exactly."""

    def __init__(self, spark: SparkSession, points: DataFrame, name: str = "table"):
        self.spark, self.points, self.name = spark, points, name

    def exists(self) -> bool:
        return not self.points.isEmpty()

    def search(self, vector: Sequence[float], k: int, jurisdiction: str | None = None) -> list[dict]:
        wanted = self.points.where(F.col("jurisdiction") == jurisdiction) if jurisdiction else self.points
        query = self.spark.createDataFrame([([float(x) for x in vector],)], "embedding array<float>")
        hits = vectors.top_k(wanted.select("id", "embedding", "payload"), query, k).select("id", "score", "payload").collect()
        return [{"id": h.id, "score": h.score, "payload": json.loads(h.payload)} for h in hits]


def load(points: DataFrame, index: RestIndex, batch: int = 512) -> None:
    """Write points (id, embedding, payload as JSON) to *index* from the executors.

    A batch is one request, and an upsert repeated after a lost executor
    changes nothing.
    """

    def write(rows: Iterator) -> None:
        while piece := list(islice(rows, batch)):
            index.upsert([{"id": r.id, "vector": list(r.embedding), "payload": json.loads(r.payload)} for r in piece])

    points.select("id", "embedding", "payload").foreachPartition(write)


def prune(index: RestIndex, embeddings: DataFrame, id_col: str = "text_id", jurisdiction: str | None = None) -> int:
    """Delete the index's points that *embeddings* no longer has, page by page; how many.

    Only a page of ids is on the driver at a time.
    """
    spark, gone = embeddings.sparkSession, 0
    for page in index.ids(jurisdiction):
        listed = spark.createDataFrame([(x,) for x in page], "id string")
        lost = [r.id for r in F.broadcast(listed).join(embeddings.select(F.col(id_col).alias("id")), "id", "left_anti").collect()]
        if lost:
            index.delete(lost)
            gone += len(lost)
    return gone
