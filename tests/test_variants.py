"""Forms of divisions, interjections and stage directions, a day at a time."""

from turnstone.sources.transcripts import Day

HEAD = "<hansard id='x'><name>House</name><house>House</house><proceeding uid='p'><name>P</name><subject uid='s'><name>S</name>{}</subject></proceeding></hansard>"


def day(body):
    made = Day("wa", "2025-03-04", "h")
    made.extract(HEAD.format(body).encode())
    made.finish({})
    rows = {}
    for table, row in made.rows:
        rows.setdefault(table, []).append(row)
    return rows, made


def test_counts_in_text_and_derived_result():
    rows, _ = day("<division><ayesCount>7</ayesCount><noesCount num='19'/><pairsCount>0</pairsCount></division>")
    (d,) = rows["divisions"]
    assert (d["ayes_count"], d["noes_count"], d["pairs_count"], d["result"]) == (7, 19, 0, "noes")
    assert day("<division vote='ayes'><ayesCount>7</ayesCount><noesCount>19</noesCount></division>")[0]["divisions"][0]["result"] == "ayes"
    assert day("<division><ayesCount>7</ayesCount><noesCount>7</noesCount></division>")[0]["divisions"][0]["result"] is None


def test_division_as_it_was_printed():
    table = "<text><table><rowtitle><cell>{}</cell></rowtitle><row>{}</row></table></text>"
    cells = lambda *names: "".join(f"<cell>{n}</cell>" for n in names)
    rows, _ = day("<division><page num='90'/><text id='1'>Ayes&amp;#x9;2</text><text id='2'>Noes 4</text><text id='3'>Majority 2</text>" + table.format("AYES", cells("Oak, B.", "Elm, C. (teller)", "")) + table.format("Noes", cells("Ash, D.")) + table.format("PAIRS", cells("Fir, E.")) + "<text id='4'>Motion lost.</text></division>")
    (d,) = rows["divisions"]
    assert (d["ayes_count"], d["noes_count"], d["result"]) == (2, 4, "noes")
    assert [(v["member_name"], v["vote"], v["teller"]) for v in rows["division_votes"]] == [("Oak, B.", "AYES", False), ("Elm, C.", "AYES", True), ("Ash, D.", "NOES", False), ("Fir, E.", "PAIRS", False)]
    assert [t["clean_text"] for t in rows["texts"]] == ["Ayes 2", "Noes 4", "Majority 2", "Motion lost."] and {t["page_no"] for t in rows["texts"]} == {"90"}


def test_interjections():
    talk = "<talker id='m1' kind='speech'><name>Ann</name><text id='1'>I say this.</text>{}<text id='9'>And that.</text></talker>"
    kinds = {
        "<text id='2'><event kind='interjection' id='m2'>Mr Rye</event>: Nonsense!</text>": ("m2", "Mr Rye", "Nonsense!"),
        "<text id='2'><event kind='interjection' id='m2'>Mr Rye interjected.</event></text>": ("m2", "Mr Rye", "Mr Rye interjected."),
        "<text id='2'><event kind='interjection'>Mr Rye</event><event kind='interjection' id='m2'> </event><event kind='interjection'>interjecting</event></text>": ("m2", "Mr Rye interjecting".rpartition(" ")[0], None),
        "<text id='2'><item><event kind='interjection' id='m2'>Mr Rye</event> interjected.</item></text>": ("m2", "Mr Rye", "Mr Rye interjected."),
    }
    for xml, (member, name, words) in kinds.items():
        rows, _ = day(talk.format(xml))
        ann, other = rows["talkers"]
        assert (other["member_source_id"], other["kind"]) == (member, "interjection") and other["name"].startswith(name.split()[0])
        said = [t for t in rows["texts"] if t["talker_id"] == other["talker_id"]]
        assert words is None or ([t["clean_text"] for t in said] == [words] and other["name"] == name and other["word_count"] == len(words.split()))
        assert [t["clean_text"] for t in rows["texts"] if t["talker_id"] == ann["talker_id"]] == ["I say this.", "And that."] and ann["word_count"] == 5


def test_stage_directions_and_times():
    rows, made = day(
        "<text id='1'><event>Sitting suspended from 12:58 to 14:30.</event></text><text id='2'>words</text><text id='3'><event>The committee met at 9.05</event></text>"
        "<text id='4'><event kind='meetingclosed' time='2025-03-04T18:00:00'>Closed</event></text><text id='5'><event kind='meetingtimestamp' time='2025-03-04T18:10:00'/>x</text><text id='6'><event kind='bell'>b</event></text><text id='7'><event>Quorum formed.</event></text>"
    )
    assert [(m["kind"], m["time"].strftime("%H:%M")) for m in rows["meeting_time_marks"]] == [("meetingsuspended", "12:58"), ("meetingopened", "09:05"), ("meetingclosed", "18:00")]
    assert [t["time_anchor"].strftime("%H:%M") for t in rows["texts"]] == ["14:30", "14:30", "09:05", "18:00", "18:10", "18:10", "18:10"]
    assert dict(made.unhandled) == {"event bell": 1, "event without a kind": 1}
