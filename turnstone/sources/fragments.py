"""The fragment format: a topic's turns as metadata beside its prose as marked paragraphs.

The metadata lists speakers in order; the prose marks where each begins.  A
marker claims that member's next unclaimed speaker; one that finds none starts
a speech of its own, and a marker without an id changes nothing.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections import defaultdict, deque

from .transcripts import Day, clean, make_id, parse_time

TURNS = ("speech", "question", "answer", "interjection")
SIDES = {"aye": "AYES", "noe": "NOES", "pair": "PAIRS"}


def _name(node: ET.Element) -> str:
    return node.tag.rpartition("}")[2]


class FragmentDay(Day):
    """Rows of one house's day, from one file per topic."""

    def extract(self, content: bytes) -> None:
        root = ET.fromstring(content)
        head = root.find("hansard.header")
        value = lambda name: clean(head.findtext(name)) or None
        if self.header is None:
            self.keys["house"] = value("chamber") or self.keys["house"]
            self.fragment = make_id(*self.keys.values())
            number = lambda name: int(value(name)) if (value(name) or "").isdigit() else None
            self.header = self.add("fragments", {
                "name": self.keys["house"], "parliament_num": number("parliament.number"), "session_num": number("session.number"), "session_name": value("parliament.session.name"),
                "review_stage": "draft" if value("draft") == "true" else "published", "start_time": None, "end_time": None, "start_page": None, "end_page": None,
            })
        for node in root.iter("proceeding"):
            name = clean(node.findtext("proceedinginfo/text")) or None
            row = self.proceedings.get(f"name:{name}")
            if row is None:
                order = self.next()
                row = self.proceedings[f"name:{name}"] = self.add("proceedings", {"proceeding_id": make_id(self.fragment, "proceeding", "", order), "uid": node.get("uid"), "name": name, "continued": False, "document_order": order})
            for topic in node.iter("topic"):
                self.topic(topic, row, root.find("chamber.xscript/fragment.text/body"))
        self.extracts += 1

    def topic(self, node: ET.Element, proceeding: dict, body: ET.Element | None) -> None:
        order = self.next()
        name = clean(node.findtext("topicinfo/text")) or None
        own = make_id(self.fragment, "subject", node.get("uid") or "", order)
        self.add("subjects", {"subject_id": own, "proceeding_id": proceeding["proceeding_id"], "uid": node.get("uid"), "name": name, "names": json.dumps([name]), "extract_index": self.extracts, "document_order": order})
        parents = {"subject_id": own}
        waiting: dict[str, deque] = defaultdict(deque)
        for turn in node.iter():
            if turn.tag in TURNS and (who := turn.find("talk.start/talker")) is not None and (member := clean(who.findtext("id"))):
                waiting[member].append((turn.tag, who))
        for sub in node.iter("subproceeding"):
            place = self.next()
            inner = make_id(self.fragment, "subproceeding", "", place)
            self.add("subproceedings", {"subproceeding_id": inner, "subject_id": own, "name": clean(sub.findtext("subproceedinginfo/text")) or None, "document_order": place})
            for division in sub.findall("division"):
                self.votes(division, parents | {"subproceeding_id": inner})
        for division in node.findall("division"):
            self.votes(division, parents)
        talker, index = None, 0
        for p in (x for x in body.iter() if _name(x) == "p") if body is not None else ():
            # Markers without an id open no turn, and links of this mode only mark a place.
            marker = next((s for s in p.iter() if s.get("data-mode") == "member" and _name(s) in ("span", "b") and (s.get("data-value") or "").strip()), None)
            if marker is not None:
                talker, index = self.claim(marker, waiting, parents, own), 0
            self.paragraph(p, parents, talker, index)
            index += 1

    def claim(self, marker: ET.Element, waiting: dict[str, deque], parents: dict, container: str) -> dict:
        member = marker.get("data-value").strip()
        kind, who = waiting[member].popleft() if waiting[member] else ("speech", None)
        order = self.next()
        value = lambda name: clean(who.findtext(name)) or None if who is not None else None
        return self.add("talkers", parents | {
            "talker_id": make_id(self.fragment, "talker", "", order), "member_source_id": member, "name": value("name") or clean("".join(marker.itertext())).rstrip(":").strip() or None, "kind": kind, "electorate": value("electorate"), "portfolios": "[]",
            "start_time": parse_time(value("talk.time")), "kind_inferred": False, "paragraph_count": 0, "word_count": 0, "document_order": order, "_container": container,
        })

    def paragraph(self, p: ET.Element, parents: dict, talker: dict | None, index: int) -> None:
        order = self.next()
        part = lambda name: next((clean("".join(s.itertext())) for s in p.iter() if s.get("class") == name), "")
        clock = part("Time-H") + part("HiddenTime-H")
        time = parse_time(f"{self.keys['date']}T{clock}") if re.fullmatch(r"\d\d:\d\d(:\d\d)?", clock) else None
        style = p.get("class")
        raw = "".join(p.itertext())
        self.add("texts", parents | {
            "text_id": make_id(self.fragment, "text", "", index, order), "talker_id": talker and talker["talker_id"], "kind": "heading" if (style or "").endswith("-H") else None, "raw_text": raw, "clean_text": clean(raw), "para_index": index,
            "time_anchor": self.localized(time)[0], "style": style, "document_order": order,
        })
        if talker is not None:
            talker["start_time"] = talker["start_time"] or time
            talker["paragraph_count"] += 1
            talker["word_count"] += len(clean(raw).split())

    def votes(self, node: ET.Element, parents: dict) -> None:
        order = self.next()
        own = make_id(self.fragment, "division", "", order)
        count = lambda side: int(text) if (text := clean(node.findtext(f"{side}/count"))).isdigit() else None
        ayes, noes = count("ayes"), count("noes")
        result = None if ayes is None or noes is None or ayes == noes else "ayes" if ayes > noes else "noes"
        self.add("divisions", parents | {"division_id": own, "result": result, "ayes_count": ayes, "noes_count": noes, "pairs_count": len(list(node.iter("pair"))) or None, "document_order": order})
        for side, vote in SIDES.items():
            for i, member in enumerate(node.iter(side)):
                source, name = clean(member.findtext("id")) or None, clean(member.findtext("name")) or None
                self.add("division_votes", {"vote_id": make_id(own, "vote", source or name, f"{side}{i}"), "division_id": own, "member_source_id": source, "member_name": name, "vote": vote, "teller": False, "proxy": False})
