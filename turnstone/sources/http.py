"""HTTP behind one small interface, so that every caller can be given another transport."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Reply:
    status: int
    content: bytes = b""

    def json(self) -> object:
        return json.loads(self.content)


@dataclass(frozen=True)
class Call:
    method: str
    url: str
    body: bytes | None = None
    headers: dict[str, str] = field(default_factory=dict)


class TransportError(OSError):
    """The other side could not be reached."""


class StatusError(RuntimeError):
    """The other side answered with an error that trying again does not help."""

    def __init__(self, reply: Reply, url: str):
        super().__init__(f"{reply.status} from {url}: {reply.content[:200]!r}")
        self.reply = reply


Transport = Callable[[Call], Reply]


def network(timeout: float = 60.0, agent: str = "turnstone (open transcript analytics)") -> Transport:
    """The real network."""

    def send(call: Call) -> Reply:
        request = urllib.request.Request(call.url, call.body, {"User-Agent": agent} | call.headers, method=call.method)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as reply:
                return Reply(reply.status, reply.read())
        except urllib.error.HTTPError as error:
            return Reply(error.code, error.read())
        except OSError as error:
            raise TransportError(str(error)) from error

    return send


class Client:
    """Calls with retries: unreachable hosts, 429 and 5xx are tried again, each time after a longer wait."""

    def __init__(self, transport: Transport | None = None, attempts: int = 4, wait: Callable[[float], None] = time.sleep):
        self.transport, self.attempts, self.wait = transport or network(), attempts, wait

    def call(self, method: str, url: str, body: object = None, params: dict[str, str] | None = None, headers: dict[str, str] | None = None) -> Reply:
        if params:
            url = f"{url}?{urllib.parse.urlencode(params)}"
        extra = {"Content-Type": "application/json"} if body is not None else {}
        call = Call(method, url, json.dumps(body).encode() if body is not None else None, extra | (headers or {}))
        for attempt in range(self.attempts):
            last = attempt == self.attempts - 1
            try:
                reply = self.transport(call)
            except TransportError:
                if last:
                    raise
            else:
                if reply.status != 429 and reply.status < 500:
                    return reply
                if last:
                    raise StatusError(reply, url)
            self.wait(min(30.0, 2.0**attempt))
        raise AssertionError("unreachable")

    def get(self, url: str, **params: str) -> Reply:
        return self.call("GET", url, params=params)

    def must(self, method: str, url: str, body: object = None, **options: dict) -> object:
        """The JSON of a reply that is no error."""
        reply = self.call(method, url, body, **options)
        if reply.status >= 400:
            raise StatusError(reply, url)
        return reply.json() if reply.content else None
