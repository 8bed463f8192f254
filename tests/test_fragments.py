import json

import pandas as pd

from turnstone.sources.transcripts import parse_day

HEAD = "<hansard><hansard.header><parliament.number>58</parliament.number><chamber>Upper House</chamber><draft>true</draft></hansard.header><chamber.xscript><fragment.data><proceeding><proceedinginfo><text>Bills</text></proceedinginfo>"
MARK = '<p class="Normal-P"><span data-mode="member" data-value="{0}">{1}</span> <span class="Time-H">{2}</span><span class="HiddenTime-H">:30</span> {3}</p>'
ONE = (
    HEAD + "<topic uid='t1'><topicinfo><text>Ferries</text></topicinfo><question><talk.start><talker><id>7</id><name>Ann</name></talker></talk.start></question><answer><talk.start><talker><id>8</id><name>Bo</name></talker></talk.start></answer></topic></proceeding></fragment.data>"
    "<fragment.text><body><p class='SubDebate-H'>Ferries</p>" + MARK.format(7, "ANN", "10:04", "When do they run?") + '<p class="N"><span data-mode="member">nobody</span> and how?</p>' + MARK.format(8, "BO", "10:05", "Daily.") + MARK.format(7, "ANN", "10:06", "Thanks.")
    + "</body></fragment.text></chamber.xscript></hansard>"
)
TWO = HEAD + "<topic><topicinfo><text>Bill</text></topicinfo><subproceeding><subproceedinginfo><text>Detail</text></subproceedinginfo><division><ayes><count>1</count><aye><id>7</id><name/></aye></ayes><noes><count>2</count><noe><id>8</id><name/></noe><noe><id>9</id><name/></noe></noes><pairs><group><pair><id>1</id></pair><pair><id>2</id></pair></group></pairs></division></subproceeding></topic></proceeding></fragment.data></chamber.xscript></hansard>"


def test_fragments():
    files = pd.DataFrame([("nsw", "2025-06-24", "lc", n, t.encode()) for n, t in (("1.xml", ONE), ("2.xml", TWO))], columns=["jurisdiction", "date", "house_code", "name", "content"])
    rows = parse_day(files)
    by = {t: [json.loads(b) for b in g.body] for t, g in rows.groupby("table")}
    assert {k: len(v) for k, v in by.items()} == {"fragments": 1, "proceedings": 1, "subjects": 2, "subproceedings": 1, "talkers": 3, "texts": 5, "divisions": 1, "division_votes": 5}
    assert [(t["member_source_id"], t["kind"], t["name"], t["paragraph_count"]) for t in by["talkers"]] == [("7", "question", "Ann", 2), ("8", "answer", "Bo", 1), ("7", "speech", "ANN", 1)]
    assert by["talkers"][0]["start_time"] == "2025-06-24T10:04:30+10:00"
    assert by["texts"][0]["kind"] == "heading" and by["texts"][0]["talker_id"] is None
    assert by["divisions"][0]["result"] == "noes" and by["divisions"][0]["pairs_count"] == 2
    assert [v["vote"] for v in by["division_votes"]] == ["AYES", "NOES", "NOES", "PAIRS", "PAIRS"]
