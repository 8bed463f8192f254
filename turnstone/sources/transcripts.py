"""Raw transcript files to relational tables, one sitting day of a house at a time.

Files are scanned as binary rows and grouped by (jurisdiction, date, house
folder); each group is parsed in one task into tagged rows, from which each
table is selected with its schema.  A day's files are a few megabytes, so a
group is bounded by the source, not by the archive.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import html
import json
import re
import uuid
import xml.etree.ElementTree as ET
from collections import Counter
from collections.abc import Iterable
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.functions.columns import NAMESPACE

from .schemas import PARSE_ERRORS, PARTITIONS, TABLES
from .tables import overwrite_partitions, temporary_path

#: The zone of a naive time, by jurisdiction.
ZONES = {"wa": "Australia/Perth", "sa": "Australia/Adelaide", "nsw": "Australia/Sydney", "au": "Australia/Sydney", "nz": "Pacific/Auckland", "scot": "Europe/London"}
ROLL_AFTER, MOST_ROLLS = dt.timedelta(hours=12), 2
#: Kinds that a later turn of the same member takes on.
LASTING = ("speech", "question", "answer")
KINDS = (*LASTING, "interjection")
#: Events that mark a phase of the sitting, and the labels of those that only say so.
PHASES = ("meetingopened", "meetingclosed", "meetingsuspended", "meetingresumed")
SUSPENDED = re.compile(r"\[?sitting suspended from (\d{1,2})[:.](\d{2}) to (\d{1,2})[:.](\d{2})\]?\.?", re.I)
OPENED = re.compile(r"the committee met at (\d{1,2})[:.](\d{2})\.?", re.I)
#: "Ms Grey interjected."
INTERJECTED = re.compile(r"(.+?)\s+interject(?:ed|ing)\s*[.!:]?", re.I)
COUNTED = re.compile(r"(ayes|noes|pairs|abstentions)\s+(\d+)", re.I)
TELLER = re.compile(r"\s*\(teller\)", re.I)
VOTES = {"ayes": "AYES", "aye": "AYES", "noes": "NOES", "no": "NOES", "pairs": "PAIRS", "pair": "PAIRS", "abstentions": "ABSTENTIONS"}


def make_id(*parts: object) -> str:
    return str(uuid.uuid5(NAMESPACE, "\x1f".join("\x00" if p is None else str(p) for p in parts)))


def clean(text: str | None) -> str:
    return " ".join(html.unescape(text or "").split())


def parse_time(value: str | None) -> dt.datetime | None:
    if not value:
        return None
    try:
        return dt.datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    except ValueError:
        return None


def _number(value: str | None) -> int | None:
    found = re.search(r"\d+", value or "")
    return int(found[0]) if found else None


def _child(node: ET.Element, name: str) -> str | None:
    found = node.find(name)
    return clean("".join(found.itertext())) or None if found is not None else None


def _attribute(node: ET.Element, path: str, name: str) -> str | None:
    found = node.find(path)
    return found.get(name) if found is not None else None


class Day:
    """Rows of one house's day, built in reading order over its extracts."""

    def __init__(self, jurisdiction: str, date: str, house: str):
        self.keys = {"jurisdiction": jurisdiction, "date": date, "house": house}
        self.rows: list[tuple[str, dict]] = []
        self.order = 0
        self.page: str | None = None
        self.time: dt.datetime | None = None
        self.unhandled: Counter[str] = Counter()
        self.proceedings: dict[str, dict] = {}
        self.seen_texts: set[str] = set()
        self.header: dict | None = None
        self.extracts = 0
        self.day = dt.date.fromisoformat(date)

    # -- rows --------------------------------------------------------------------------------------

    def add(self, table: str, row: dict) -> dict:
        self.rows.append((table, row))
        return row

    def next(self) -> int:
        self.order += 1
        return self.order - 1

    def extract(self, content: bytes) -> None:
        root = ET.fromstring(content)
        if self.header is None:
            house = _child(root, "house")
            name = _child(root, "name")
            if house:
                self.keys["house"] = name if name and name != house else house
            self.fragment = make_id(*self.keys.values())
            self.header = self.add("fragments", {
                "committee_name": house if name and house and name != house else None, "source_doc_id": root.get("id"), "schema_version": root.get("schemaVersion"), "name": name, "venue": _child(root, "venue"),
                "parliament_num": _number(_child(root, "parliamentNum")), "session_num": _number(_child(root, "sessionNum")), "parliament_name": _child(root, "parliamentName"), "session_name": _child(root, "sessionName"),
                "review_stage": _child(root, "reviewStage"), "start_time": parse_time(_attribute(root, "startTime", "time")), "end_time": parse_time(_attribute(root, "endTime", "time")),
                "start_page": _attribute(root, "startPage", "num"), "end_page": _attribute(root, "endPage", "num"), "lang": root.get("{http://www.w3.org/XML/1998/namespace}lang"),
            })
        else:
            self.header["end_page"] = _attribute(root, "endPage", "num") or self.header["end_page"]
        for node in root.iter("attendee"):
            self.add("attendees", {"attendee_id": make_id(self.fragment, "attendee", self.next()), "kind": node.get("kind"), "name": clean("".join(node.itertext())), "reference_id": node.get("referenceid")})
        for node in root.findall("proceeding"):
            self.proceeding(node)
        self.extracts += 1

    def proceeding(self, node: ET.Element) -> None:
        """Proceedings continue over extracts, by uid or else by name."""
        name, uid = _child(node, "name"), node.get("uid")
        key = uid or f"name:{name}"
        row = self.proceedings.get(key)
        if row is None:
            order = self.next()
            row = self.proceedings[key] = self.add("proceedings", {"proceeding_id": make_id(self.fragment, "proceeding", uid or "", order), "uid": uid, "name": name, "continued": node.get("continued") == "true", "document_order": order})
        self.walk(node, {"proceeding_id": row["proceeding_id"]}, row["proceeding_id"])

    def walk(self, node: ET.Element, parents: dict, container: str) -> None:
        for child in node:
            tag = child.tag
            if tag == "page":
                self.page = child.get("num") or self.page
            elif tag == "text":
                self.text(child, parents, container)
            elif tag == "talker":
                self.talker(child, parents, container)
            elif tag == "division":
                self.division(child, parents)
            elif tag == "bills":
                for bill in child.iter("bill"):
                    self.add("bill_refs", {"bill_ref_id": make_id(parents.get("subject_id"), "bill", bill.get("uid") or bill.get("id"), self.next()), "subject_id": parents.get("subject_id"), "uid": bill.get("uid"), "source_id": bill.get("id"), "reference_id": bill.get("referenceid"), "name": clean("".join(bill.itertext()))})
            elif tag in ("subject", "subproceeding", "clause"):
                order, uid = self.next(), child.get("uid")
                own = make_id(self.fragment, tag, uid or "", order)
                row = {f"{tag}_id": own, "uid": uid, "name": _child(child, "name"), "document_order": order}
                if tag == "subject":
                    names = [clean("".join(n.itertext())) for n in child.findall("name")]
                    row |= {"proceeding_id": parents.get("proceeding_id"), "names": json.dumps(names, ensure_ascii=False), "extract_index": self.extracts}
                    below = {"subject_id": own}  # what lies below a subject finds its proceeding through it
                else:
                    row |= {k: parents.get(k) for k in ("subject_id", "subproceeding_id") if f"{tag}_id" != k}
                    below = parents | {f"{tag}_id": own}
                self.add({"subject": "subjects", "subproceeding": "subproceedings", "clause": "clauses"}[tag], row)
                self.walk(child, below, own)

    def text(self, node: ET.Element, parents: dict, container: str, index: int = 0, talker: dict | None = None) -> None:
        source = node.get("id")
        if source and source in self.seen_texts:
            return
        if source:
            self.seen_texts.add(source)
        events = list(node.iter("event"))
        if events and events[0].get("kind") == "interjection" and not clean("".join(_before(node, events[0]))):
            self.interjection(node, events, parents, container)
            return
        for event in events:
            self.event(event, parents, container)
        kind = next((k for k in ("heading", "subheading", "item") if node.find(k) is not None), None)
        page = next((p.get("num") for p in node.iter("page")), None)
        self.page = page or self.page
        raw = "".join(_spoken(node))
        self.time = parse_time(_attribute(node, "timeStamp", "time")) or self.time
        style = next((s for s in node.iter("span")), None)
        order = self.next()
        self.add("texts", parents | {
            "text_id": make_id(self.fragment, "text", source or "", index, order), "talker_id": talker and talker["talker_id"], "source_id": source, "kind": kind, "raw_text": raw, "clean_text": clean(raw), "para_index": index,
            "page_no": self.page, "time_anchor": self.localized(self.time)[0], "style": style.get("style") if style is not None else None, "mapped_style": style.get("mappedstyle") if style is not None else None, "document_order": order,
        })
        if talker is not None:
            talker["paragraph_count"] += 1
            talker["word_count"] += len(clean(raw).split())

    def event(self, node: ET.Element, parents: dict, container: str) -> None:
        """A mark of the sitting's phase, or the label of an interjection within someone's text."""
        kind, label = node.get("kind"), clean("".join(node.itertext()))
        if kind == "interjection":
            self.interjector([node], label, parents, container)
            return
        at = parse_time(node.get("time"))
        if not kind:
            clock = lambda hour, minute: dt.datetime.combine(self.day, dt.time(int(hour), int(minute))) if int(hour) < 24 and int(minute) < 60 else None
            if m := SUSPENDED.fullmatch(label):
                self.mark("meetingsuspended", clock(m[1], m[2]), label)
                self.time = clock(m[3], m[4]) or self.time
            elif m := OPENED.fullmatch(label):
                self.mark("meetingopened", clock(m[1], m[2]), label)
                self.time = clock(m[1], m[2]) or self.time
            else:
                self.unhandled["event without a kind"] += 1
            return
        self.time = at or self.time
        if kind in PHASES:
            self.mark(kind, at, label)
        elif kind != "meetingtimestamp":
            self.unhandled[f"event {kind}"] += 1

    def mark(self, kind: str, at: dt.datetime | None, label: str) -> None:
        self.add("meeting_time_marks", {"mark_id": make_id(self.fragment, "mark", self.next()), "kind": kind, "time": self.localized(at)[0], "label": label or None})

    def interjector(self, events: list[ET.Element], label: str, parents: dict, container: str) -> dict:
        """The turn of an interjection; a label may be split over several events, one of which has the member."""
        known = next((e for e in events if e.get("id")), events[0])
        stub = INTERJECTED.fullmatch(label)
        order = self.next()
        row = {"talker_id": make_id(self.fragment, "talker", "", order), "member_source_id": known.get("id"), "member_reference_id": known.get("referenceid"), "name": (stub[1] if stub else label).rstrip(":") or None, "role": known.get("role")}
        return self.add("talkers", parents | row | {"kind": "interjection", "kind_inferred": False, "paragraph_count": 0, "word_count": 0, "document_order": order, "_container": container})

    def interjection(self, node: ET.Element, events: list[ET.Element], parents: dict, container: str) -> None:
        """A text that is an interjection: its words are the interjector's, or its whole sentence where it only says so."""
        self.time = parse_time(_attribute(node, "timeStamp", "time")) or self.time
        label = clean("".join("".join(e.itertext()) for e in events))
        outside = "".join(_spoken(node))
        words = clean(outside).lstrip(":").strip()
        whole = f"{label} {words}" if words else label
        if INTERJECTED.fullmatch(whole):
            row, raw, said = self.interjector(events, whole, parents, container), whole, whole
        else:
            row, raw, said = self.interjector(events, label, parents, container), outside if words else label, words or label
        order, source = self.next(), node.get("id")
        self.add("texts", parents | {
            "text_id": make_id(self.fragment, "text", source or "", 0, order), "talker_id": row["talker_id"], "source_id": source, "raw_text": raw, "clean_text": said, "para_index": 0, "page_no": self.page,
            "time_anchor": self.localized(self.time)[0], "style": node.get("style"), "mapped_style": node.get("mappedstyle"), "document_order": order,
        })
        row["paragraph_count"], row["word_count"] = 1, len(said.split())

    def talker(self, node: ET.Element, parents: dict, container: str) -> None:
        order = self.next()
        kind = node.get("kind")
        party = node.find("party")
        row = self.add("talkers", parents | {
            "talker_id": make_id(self.fragment, "talker", node.get("uid") or "", order), "uid": node.get("uid"), "member_source_id": node.get("id"), "member_reference_id": node.get("referenceid"), "name": _child(node, "name"),
            "role": node.get("role"), "kind": kind if kind in KINDS else None, "party": clean("".join(party.itertext())) or None if party is not None else None, "party_source_id": party.get("id") if party is not None else None,
            "party_abbreviation": party.get("abbreviation") if party is not None else None, "electorate": _child(node, "electorate"), "portfolios": json.dumps([clean("".join(p.itertext())) for p in node.iter("portfolio")], ensure_ascii=False),
            "first_speech": node.get("firstspeech") == "true" or node.find("firstSpeech") is not None, "continued": node.get("continued") == "true", "start_time": parse_time(_attribute(node, "startTime", "time")), "kind_inferred": False,
            "paragraph_count": 0, "word_count": 0, "document_order": order, "_container": container, "_fixed": bool(kind) and kind not in KINDS,
        })
        index = 0
        for child in node:
            if child.tag == "page":
                self.page = child.get("num") or self.page
            elif child.tag == "text":
                self.text(child, parents, container, index, row)
                index += 1

    def division(self, node: ET.Element, parents: dict) -> None:
        """Counts and votes as elements, or as lines "Ayes 3" and tables with the group's name for a title."""
        order = self.next()
        counts = {k: _number(_attribute(node, f"{k}Count", "num") or _child(node, f"{k}Count")) for k in ("ayes", "noes", "pairs", "abstentions")}
        own = make_id(self.fragment, "division", node.get("uid") or "", order)
        row = self.add("divisions", {k: v for k, v in parents.items() if k != "proceeding_id"} | {"division_id": own, "uid": node.get("uid"), "source_id": node.get("id"), "document_order": order})
        below, listed, index = parents | {"division_id": own}, [], 0
        for child in node:
            if child.tag == "page":
                self.page = child.get("num") or self.page
            elif child.tag == "talker":
                self.talker(child, below, own)
            elif child.tag == "data":
                listed += [(m, m.get("name") or clean("".join(m.itertext())), VOTES.get((m.get("vote") or "").lower())) for m in child.iter("member")]
            elif child.tag == "text":
                title = child.find("table/rowtitle")
                group = VOTES.get(clean("".join(title.itertext())).lower()) if title is not None else None
                if group:
                    names = [clean("".join(cell.itertext())) for row_ in child.findall("table/row") for cell in row_.iter("cell")]
                    listed += [(ET.Element("member"), name, group) for name in names if name and name.lower() not in VOTES]
                    continue
                if m := COUNTED.fullmatch(clean("".join(_spoken(child)))):
                    counts[m[1].lower()] = int(m[2])
                self.text(child, below, own, index)
                index += 1
        for i, (member, name, vote) in enumerate(listed):
            teller = member.get("teller") == "true" or bool(TELLER.search(name))
            name = TELLER.sub("", name).strip() or None
            self.add("division_votes", {"vote_id": make_id(own, "vote", member.get("id") or name, i), "division_id": own, "member_source_id": member.get("id"), "member_name": name, "vote": vote, "teller": teller, "proxy": member.get("proxy") == "true", "proxy_source_id": member.get("proxyId"), "proxy_name": member.get("proxyName")})
        result = (node.get("vote") or "").lower() or None
        if result is None and None not in (counts["ayes"], counts["noes"]) and counts["ayes"] != counts["noes"]:
            result = "ayes" if counts["ayes"] > counts["noes"] else "noes"
        row |= {"result": result} | {f"{k}_count": v for k, v in counts.items()}

    # -- passes over the day ------------------------------------------------------------------------

    def localized(self, time: dt.datetime | None) -> tuple[dt.datetime | None, str | None]:
        if time is None or time.tzinfo is not None:
            return time, "document" if time else None
        return time.replace(tzinfo=ZoneInfo(ZONES.get(self.keys["jurisdiction"], "Australia/Sydney"))), "zone"

    def clock(self) -> None:
        """Localise times and roll readings that fall far behind the last one to the next day."""
        rolled, last = 0, None
        for table, row in self.rows:
            if table != "talkers" or row.get("start_time") is None:
                continue
            time, source = self.localized(row["start_time"])
            time += dt.timedelta(days=rolled)
            if last is not None and last - time > ROLL_AFTER and rolled < MOST_ROLLS:
                rolled += 1
                time += dt.timedelta(days=1)
            row |= {"start_time": time, "time_source": source, "clock_rolled": rolled > 0}
            last = time
        for name in ("start_time", "end_time"):
            self.header[name] = self.localized(self.header[name])[0]
        if self.header["start_time"] and self.header["end_time"] and self.header["end_time"] < self.header["start_time"]:
            self.header["end_time"] += dt.timedelta(days=1)

    def infer_kinds(self) -> None:
        """Untyped turns take the member's last lasting kind within the same container."""
        last: dict[tuple, str] = {}
        for table, row in self.rows:
            if table != "talkers" or row.get("_fixed") or not row.get("member_source_id"):
                continue
            key = row["_container"], row["member_source_id"]
            if row["kind"] is None and key in last:
                row |= {"kind": last[key], "kind_inferred": True}
            elif row["kind"] in LASTING:
                last[key] = row["kind"]

    def finish(self, meta: dict) -> Iterable[tuple[str, dict]]:
        if self.header is None:
            return []
        self.clock()
        self.infer_kinds()
        body = [[t, {k: str(v) for k, v in r.items() if k not in ("review_stage", "source_url", "retrieved_at") and not k.startswith("_")}] for t, r in self.rows]
        url = (meta.get("event") or {}).get("url")
        self.header |= {"source_url": url, "retrieved_at": parse_time(meta.get("harvested_at")), "extract_count": self.extracts, "content_hash": hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()}
        return [(t, {"fragment_id": self.fragment} | self.keys | {k: v for k, v in r.items() if not k.startswith("_")}) for t, r in self.rows]


def _before(node: ET.Element, until: ET.Element) -> Iterable[str]:
    """What is spoken in *node* before one of its descendants."""
    stack = [iter([node])]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif child is until:
            return
        elif child.tag not in ("by", "timeStamp", "page"):
            yield child.text or ""
            stack.append(iter(child))


def _spoken(node: ET.Element) -> Iterable[str]:
    """Text in reading order without speaker labels, time stamps and interjections."""
    if node.tag in ("by", "timeStamp", "page") or (node.tag == "event" and node.get("kind")):
        return
    yield node.text or ""
    for child in node:
        yield from _spoken(child)
        yield child.tail or ""


def _plain(value: object) -> object:
    return value.isoformat() if isinstance(value, dt.datetime) else value


def parse_day(files: pd.DataFrame) -> pd.DataFrame:
    """Tagged rows (table, body as JSON) of one house's day.

    A file that cannot be read gives a row of ``parse_errors`` and takes
    nothing else from its day.
    """
    from .federal import FederalDay
    from .fragments import FragmentDay

    first = files.iloc[0]
    day = {"au": FederalDay, "nsw": FragmentDay}.get(first.jurisdiction, Day)(first.jurisdiction, str(first.date), first.house_code)
    meta: dict = {}
    errors: list[tuple[str, dict]] = []
    first_keys = {"jurisdiction": first.jurisdiction, "date": str(first.date)}
    for row in files.sort_values("name").itertuples():
        if row.name == "meta.json":
            try:
                meta = json.loads(row.content)
            except ValueError:
                meta = {}
        elif row.name.endswith(".xml") and not row.name.startswith("toc"):
            try:
                day.extract(row.content)
            except Exception as error:  # noqa: BLE001  whatever a file holds, the other files of the day count
                errors.append(("parse_errors", first_keys | {"house": first.house_code, "name": row.name, "error": f"{type(error).__name__}: {error}"[:500]}))
    try:
        rows = list(day.finish(meta))
    except Exception as error:  # noqa: BLE001
        rows = []
        errors.append(("parse_errors", first_keys | {"house": first.house_code, "name": None, "error": f"{type(error).__name__}: {error}"[:500]}))
    errors += [("parse_errors", first_keys | {"house": first.house_code, "name": None, "error": f"not understood: {what}, {n} times"}) for what, n in getattr(day, "unhandled", {}).items()]
    out = [(t, json.dumps({k: _plain(v) for k, v in r.items()}, ensure_ascii=False)) for t, r in [*rows, *errors]]
    return pd.DataFrame(out, columns=["table", "body"])


def raw_files(spark: SparkSession, root: str) -> DataFrame:
    place = r"([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/([^/]+)/([^/]+)$"
    part = lambda i, name: F.regexp_extract("path", place, i).alias(name)
    files = spark.read.format("binaryFile").load(f"{root}/*/*/*/*")
    return files.select(part(1, "jurisdiction"), part(2, "date"), part(3, "house_code"), part(4, "name"), "content").where("date <> ''")


def normalize(files: DataFrame) -> dict[str, DataFrame]:
    """The relational tables of raw files (jurisdiction, date, house_code, name, content), and ``parse_errors``.

    Every file is parsed once: the tagged rows are written to the shared
    folder by table, and each table reads its own part of them.
    """
    spark = files.sparkSession
    path = temporary_path(spark, "tagged")
    tagged = files.groupBy("jurisdiction", "date", "house_code").applyInPandas(parse_day, "table string, body string")
    tagged.write.partitionBy("table").parquet(path)
    written = spark.read.schema("body string, table string").parquet(path)
    pick = lambda name, schema: written.where(F.col("table") == name).select(F.from_json("body", schema).alias("r")).select("r.*")
    return {name: pick(name, schema) for name, schema in (TABLES | {"parse_errors": PARSE_ERRORS}).items()}


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Replace the partitions of the days at hand, table by table."""
    for name, df in tables.items():
        overwrite_partitions(df, f"{root}/{name}", PARTITIONS)
