import pandas as pd

from turnstone.sources.transcripts import parse_day

WHO = "<talk.start><talker><page.no>{page}</page.no><time.stamp/><name role='metadata'>{name}</name><name.id>{id}</name.id><electorate>E</electorate><party>P</party><first.speech>{first}</first.speech></talker></talk.start>"
SAID = "<talk.text><body><p class='N'>{0}</p></body></talk.text>"


def turn(tag, id_, text, inner="", first="", page=7):
    return f"<{tag}>{WHO.format(page=page, name=f'N{id_}', id=id_, first=first)}{SAID.format(text)}{inner}</{tag}>"


PAGE = (
    "<hansard version='2.2'><session.header><parliament.no>3</parliament.no><session.no>1</session.no><chamber>REPS</chamber><page.no>1</page.no><proof>0</proof></session.header><chamber.xscript>"
    "<debate><debateinfo><title>BILLS</title><page.no>5</page.no></debateinfo><subdebate.1><subdebateinfo><title>Ferry Bill 2025</title><page.no>6</page.no></subdebateinfo>"
    + turn("speech", 1, "<span class='HPS-Time'>23:50</span> I begin here.", turn("interjection", 2, "No!") + turn("continue", 1, "As I said, yes.", page=8), first="1")
    + "<subdebate.2><subdebateinfo><title>Second Reading</title></subdebateinfo>" + turn("speech", 3, "<span class='HPS-Time'>00:05</span> After midnight.") + "</subdebate.2></subdebate.1>"
    "<division><division.data><ayes><num.votes>2</num.votes><names><name>A, B. (Teller)</name><name>C, D.</name></names></ayes><noes><num.votes>1</num.votes><names><name>E, F.</name></names></noes></division.data></division>"
    "</debate></chamber.xscript></hansard>"
)


def test_federal_day():
    import json

    rows = parse_day(pd.DataFrame([("au", "2025-03-04", "reps", "day.xml", PAGE.encode())], columns=["jurisdiction", "date", "house_code", "name", "content"]))
    by = {t: [json.loads(b) for b in g.body] for t, g in rows.groupby("table")}
    assert {k: len(v) for k, v in by.items()} == {"fragments": 1, "proceedings": 1, "subjects": 2, "subproceedings": 1, "talkers": 4, "texts": 4, "divisions": 1, "division_votes": 3, "bill_refs": 1}
    assert by["fragments"][0]["house"] == "House of Representatives"
    assert [(t["member_source_id"], t["kind"], t["continued"]) for t in by["talkers"]] == [("1", "speech", False), ("2", "interjection", False), ("1", "speech", True), ("3", "speech", False)]
    assert by["talkers"][0]["first_speech"] and by["talkers"][3]["clock_rolled"] and by["talkers"][3]["start_time"].startswith("2025-03-05T00:05")
    assert by["talkers"][3]["subproceeding_id"] == by["subproceedings"][0]["subproceeding_id"]
    assert by["subjects"][1]["name"] == "BILLS" and by["divisions"][0]["subject_id"] == by["subjects"][1]["subject_id"] and by["divisions"][0]["result"] == "ayes"
    assert by["division_votes"][0]["teller"] and by["division_votes"][0]["member_name"] == "A, B."
    assert [t["page_no"] for t in by["texts"]][:3] == ["7", "7", "8"]
