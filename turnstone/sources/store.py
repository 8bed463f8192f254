"""The raw store and its adapters: where harvested files lie before they are parsed."""

from __future__ import annotations

import datetime as dt
import json
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator
from pathlib import Path


class Adapter(ABC):
    """A source of sitting days; network access belongs to the implementation."""

    jurisdiction: str

    @abstractmethod
    def discover(self, start: dt.date, end: dt.date) -> Iterable[dict]:
        """Events with ``date`` and ``house``, newest first."""

    @abstractmethod
    def fetch(self, event: dict) -> Iterable[tuple[str, bytes]]:
        """(file name, content) of an event."""


_adapters: dict[str, type[Adapter]] = {}


def register(adapter: type[Adapter]) -> type[Adapter]:
    _adapters[adapter.jurisdiction] = adapter
    return adapter


def get_adapter(jurisdiction: str) -> Adapter:
    if jurisdiction not in _adapters:
        raise NotImplementedError(f"no adapter for {jurisdiction}")
    return _adapters[jurisdiction]()


def all_adapters() -> dict[str, str]:
    """What is known of each jurisdiction's source, in the order of registration."""
    return {name: getattr(adapter, "source", "") for name, adapter in _adapters.items()}


class RawStore:
    """``root/jurisdiction/date/house/file``; files are immutable unless forced."""

    def __init__(self, root: str | Path):
        self.root = Path(root)

    def day(self, jurisdiction: str, date: str, house: str) -> Path:
        return self.root / jurisdiction / date / house

    def save(self, jurisdiction: str, date: str, house: str, name: str, content: bytes, force: bool = False) -> bool:
        path = self.day(jurisdiction, date, house) / name
        if path.exists() and not force:
            return False
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        return True

    def save_meta(self, jurisdiction: str, date: str, house: str, event: dict, documents: int) -> None:
        meta = {"event": event, "documents": documents, "harvested_at": dt.datetime.now(dt.UTC).isoformat()}
        self.save(jurisdiction, date, house, "meta.json", json.dumps(meta, default=str).encode(), force=True)

    def days(self, jurisdiction: str, start: str = "0000", end: str = "9999") -> Iterator[Path]:
        """Day folders in a range of dates, in order."""
        for date in sorted((self.root / jurisdiction).glob("????-??-??")):
            if start <= date.name <= end:
                yield from sorted(p for p in date.iterdir() if p.is_dir())


def harvest(store: RawStore, adapter: Adapter, start: dt.date, end: dt.date, refresh_days: int = 0) -> int:
    """Fetch days without meta.json, and those of the last *refresh_days*; the count of days fetched.

    A day without documents is never marked, so it is tried again.
    """
    fetched = 0
    for event in sorted(adapter.discover(start, end), key=lambda e: str(e["date"]), reverse=True):
        date, house = str(event["date"]), event["house"]
        fresh = (end - dt.date.fromisoformat(date)).days < refresh_days
        if (store.day(adapter.jurisdiction, date, house) / "meta.json").exists() and not fresh:
            continue
        count = 0
        for name, content in adapter.fetch(event):
            store.save(adapter.jurisdiction, date, house, name, content, force=fresh)
            count += 1
        if count:
            store.save_meta(adapter.jurisdiction, date, house, event, count)
            fetched += 1
    return fetched
