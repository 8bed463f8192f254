"""The federal daily format: one file holds a whole day of a chamber.

Turns nest: an interjection or a continuation stands inside the turn that it
breaks into.  They become siblings, a continuation keeping the turn's kind.
The first subdebate level is the subject, the second a subproceeding.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET

from .transcripts import Day, clean, make_id, parse_time

#: The turn elements and their kinds, and the chambers' names.
TURNS = {"speech": "speech", "talk": "speech", "question": "question", "answer": "answer", "interjection": "interjection", "continue": None}
CHAMBERS = {"house of reps": "House of Representatives", "reps": "House of Representatives", "house of representatives": "House of Representatives", "senate": "Senate"}


class FederalDay(Day):
    """Rows of one chamber's day."""

    def extract(self, content: bytes) -> None:
        root = ET.fromstring(content)
        head = root.find("session.header")
        value = lambda name: clean(head.findtext(name)) or None
        chamber = value("chamber") or self.keys["house"]
        self.keys["house"] = CHAMBERS.get(chamber.lower(), chamber)
        self.fragment = make_id(*self.keys.values())
        number = lambda name: int(value(name)) if (value(name) or "").isdigit() else None
        self.header = self.add("fragments", {"schema_version": root.get("version"), "name": chamber, "parliament_num": number("parliament.no"), "session_num": number("session.no"), "review_stage": "proof" if value("proof") == "1" else "published", "start_page": value("page.no"), "start_time": None, "end_time": None, "end_page": None})
        self.extracts = 1
        for debate in root.iter("debate"):
            self.debate(debate)

    def debate(self, node: ET.Element) -> None:
        order = self.next()
        name = clean(node.findtext("debateinfo/title"))
        self.page = clean(node.findtext("debateinfo/page.no")) or self.page
        proceeding = self.add("proceedings", {"proceeding_id": make_id(self.fragment, "proceeding", "", order), "name": name, "continued": False, "document_order": order})
        subject = None
        for child in node:
            if child.tag == "subdebate.1":
                own = self.subject(proceeding, clean(child.findtext("subdebateinfo/title")), child)
                self.content(child, {"subject_id": own}, own)
            elif child.tag in TURNS or child.tag == "division":
                # What stands directly in a debate belongs to a subject named after it.
                subject = subject or self.subject(proceeding, name, node)
                self.item(child, {"subject_id": subject}, subject)

    def subject(self, proceeding: dict, name: str, node: ET.Element) -> str:
        order = self.next()
        self.page = clean(node.findtext("subdebateinfo/page.no")) or self.page
        own = make_id(self.fragment, "subject", "", order)
        self.add("subjects", {"subject_id": own, "proceeding_id": proceeding["proceeding_id"], "name": name, "names": json.dumps([name], ensure_ascii=False), "extract_index": 0, "document_order": order})
        if re.search(r"\bBill\b", name):
            self.add("bill_refs", {"bill_ref_id": make_id(own, "bill", name, order), "subject_id": own, "name": name})
        return own

    def content(self, node: ET.Element, parents: dict, container: str) -> None:
        for child in node:
            if child.tag == "subdebate.2":
                order = self.next()
                own = make_id(self.fragment, "subproceeding", "", order)
                self.add("subproceedings", {"subproceeding_id": own, "subject_id": parents["subject_id"], "name": clean(child.findtext("subdebateinfo/title")), "document_order": order})
                self.content(child, parents | {"subproceeding_id": own}, own)
            else:
                self.item(child, parents, container)

    def item(self, node: ET.Element, parents: dict, container: str) -> None:
        if node.tag == "division":
            self.votes(node, parents)
        elif node.tag in TURNS:
            self.turn(node, TURNS[node.tag], parents, container, node.tag == "continue")

    def turn(self, node: ET.Element, kind: str | None, parents: dict, container: str, continued: bool) -> None:
        who = node.find("talk.start/talker")
        value = lambda name: clean(who.findtext(name)) or None if who is not None else None
        order = self.next()
        self.page = value("page.no") or self.page
        row = self.add("talkers", parents | {
            "talker_id": make_id(self.fragment, "talker", "", order), "member_source_id": value("name.id"), "name": value("name"), "kind": kind, "party": value("party"), "electorate": value("electorate"), "portfolios": "[]",
            "first_speech": value("first.speech") == "1", "continued": continued, "start_time": self.at(value("time.stamp")), "kind_inferred": False, "paragraph_count": 0, "word_count": 0, "document_order": order, "_container": container,
        })
        for i, p in enumerate(node.findall("talk.text/body/p")):
            self.paragraph(p, parents, row, i)
        for child in node:
            if child.tag in TURNS:
                self.turn(child, TURNS[child.tag] or kind, parents, container, child.tag == "continue")

    def at(self, clock: str | None):
        return parse_time(f"{self.keys['date']}T{clock}") if clock and re.fullmatch(r"\d\d:\d\d(:\d\d)?", clock) else None

    def paragraph(self, p: ET.Element, parents: dict, row: dict, index: int) -> None:
        order = self.next()
        time = next((self.at(clean("".join(s.itertext()))) for s in p.iter("span") if s.get("class") == "HPS-Time"), None)
        row["start_time"] = row["start_time"] or time
        raw = "".join(p.itertext())
        self.add("texts", parents | {"text_id": make_id(self.fragment, "text", "", index, order), "talker_id": row["talker_id"], "raw_text": raw, "clean_text": clean(raw), "para_index": index, "page_no": self.page, "time_anchor": self.localized(time)[0], "style": p.get("class"), "document_order": order})
        row["paragraph_count"] += 1
        row["word_count"] += len(clean(raw).split())

    def votes(self, node: ET.Element, parents: dict) -> None:
        order = self.next()
        own = make_id(self.fragment, "division", "", order)
        counts = {}
        for side in ("ayes", "noes", "pairs"):
            found = clean(node.findtext(f"division.data/{side}/num.votes"))
            counts[side] = int(found) if found.isdigit() else None
        ayes, noes = counts["ayes"], counts["noes"]
        result = None if ayes is None or noes is None or ayes == noes else "ayes" if ayes > noes else "noes"
        self.add("divisions", parents | {"division_id": own, "result": result, "document_order": order} | {f"{k}_count": v for k, v in counts.items()})
        for side, vote in (("ayes", "AYES"), ("noes", "NOES"), ("pairs", "PAIRS")):
            for i, name in enumerate(node.findall(f"division.data/{side}/names/name")):
                text = clean("".join(name.itertext()))
                plain = re.sub(r"\s*\(teller\)", "", text, flags=re.I)
                self.add("division_votes", {"vote_id": make_id(own, "vote", plain, f"{side}{i}"), "division_id": own, "member_name": plain, "vote": vote, "teller": plain != text, "proxy": False})
