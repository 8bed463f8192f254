"""From raw files to every cube."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnstone.plans import gold
from turnstone.sources import tables
from turnstone.sources.transcripts import normalize, raw_files, write_tables

DAY = """<hansard id="d1"><name>Upper House</name><house>Upper House</house><startTime time="2025-03-04T13:00:00"/><endTime time="2025-03-04T18:30:00"/><reviewStage>final</reviewStage>
<proceeding uid="p1"><name>Question Time</name><subject uid="s1"><name>Harbour Works</name>
<talker id="m1" uid="k1" kind="question"><name>Eve</name><party abbreviation="RED">Red</party><text id="a1">How many cranes are there now?</text></talker>
<talker id="m2" uid="k2" kind="interjection"><name>Dan</name><text id="a2">None!</text></talker>
<talker id="m3" uid="k3" kind="answer"><name>Fay</name><portfolios><portfolio>Ports</portfolio></portfolios><text id="a3">There are four.</text></talker>
<talker id="m1" uid="k4" kind="question"><name>Eve</name><text id="a4">And next year?</text></talker></subject>
<subject uid="s2"><name>Tram  Bill</name><bills><bill id="b1" uid="u1">Tram  Bill</bill></bills><subproceeding uid="x1"><name>Second Reading</name>
<talker id="m2" uid="k5" kind="speech" firstspeech="true"><name>Dan</name><text id="a5">I rise to support it today.</text></talker></subproceeding>
<division uid="v1"><ayesCount num="2"/><noesCount num="1"/><data><member id="m1" vote="ayes" name="Eve"/><member id="m2" vote="ayes" name="Dan (teller)"/><member id="m9" vote="noes" name=""/></data></division></subject></proceeding></hansard>"""
LATER = DAY.replace("2025-03-04", "2025-03-11").replace("Second Reading", "Third Reading").replace("Upper House", "Lower House").replace("Red</party>", "Blue</party>").replace('"RED"', '"BLU"')


@pytest.fixture(scope="module")
def cubes(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("days")
    for date, house, text in (("2025-03-04", "uh", DAY), ("2025-03-11", "lh", LATER)):
        folder = root / "raw" / "wa" / date / house
        folder.mkdir(parents=True)
        (folder / "1.xml").write_text(text)
        (folder / "2.xml").write_text("<broken")
        (folder / "meta.json").write_text('{"documents": 1, "harvested_at": "2025-03-12T00:00:00+00:00"}')
    only_raw = root / "raw" / "wa" / "2025-03-18" / "lh"
    only_raw.mkdir(parents=True)
    (only_raw / "meta.json").write_text('{"documents": 3, "harvested_at": "2025-03-19T00:00:00+00:00"}')
    silver = str(root / "silver")
    write_tables(normalize(raw_files(spark, str(root / "raw"))), silver)
    subjects = spark.read.parquet(f"{silver}/subjects")
    key = subjects.select("subject_id", "fragment_id", "jurisdiction", "date", "house", "name")
    labels = [("t1", "Transport", 1, 0.8), ("t2", "Ports", 2, 0.5)]
    themes = spark.createDataFrame(labels, "theme_id string, theme_name string, rank int, score float").crossJoin(key.where(F.col("name").contains("Tram"))).withColumns({"engine": F.lit("embedding"), "model": F.lit("m"), "model_slug": F.lit("m")})
    themes = themes.unionByName(spark.createDataFrame([("t2", "Ports", 1, 0.1)], "theme_id string, theme_name string, rank int, score float").crossJoin(key.where("name = 'Harbour Works' and house = 'Upper House'")).withColumns({"engine": F.lit("embedding"), "model": F.lit("m"), "model_slug": F.lit("m")}))
    members = spark.createDataFrame([("m9", "Guy", "Green", "wa")], "source_member_id string, display_name string, party_name string, jurisdiction string")
    vocabulary = spark.createDataFrame([("wa", "second reading", "second_reading", 2), ("wa", "third reading", "third_reading", 7)], "jurisdiction string, name_lower string, stage string, stage_order int")
    frames = gold.frames_of(spark, silver, subject_themes=themes, members=members, stage_vocab=vocabulary, raw_days=tables.raw_days(spark, str(root / "raw")))
    out = str(root / "gold")
    rows = gold.write_cubes(spark, frames, out)
    return {name: spark.read.parquet(f"{out}/{name}.parquet") for name in rows}, rows, frames, out


def rows_of(cubes, name, *columns):
    return sorted(tuple(r) for r in cubes[0][name].select(*columns).collect())


def test_every_cube_is_written(cubes):
    assert list(cubes[1]) == list(gold.CUBES) and len(cubes[1]) == 20 and all(cubes[1].values())
    assert not any(c in df.columns for df in cubes[0].values() for c in ("raw_text", "clean_text"))


def test_members(cubes):
    got = {r.member_source_id: r for r in cubes[0]["member_activity"].collect()}
    eve = got["m1"]
    assert (eve.turns, eve.questions, eve.words, eve.subjects, eve.sitting_days, eve.division_votes, eve.votes_ayes) == (4, 4, 18, 2, 2, 2, 2)
    assert (eve.party_abbreviation, eve.first_sitting, eve.last_sitting) == (None, dt.date(2025, 3, 4), dt.date(2025, 3, 11)) or eve.party_abbreviation == "BLU"
    assert got["m2"].gave_first_speech and got["m2"].teller_count == 2 and got["m2"].speeches == 2
    assert (got["m9"].member_name, got["m9"].party, got["m9"].turns, got["m9"].votes_noes) == ("Guy", "Green", None, 2)
    weeks = cubes[0]["member_activity_by_week"].where("member_source_id = 'm1'").orderBy("iso_week").collect()
    assert [(w.iso_year, w.iso_week, w.house, w.turns, w.subjects) for w in weeks] == [(2025, 10, "Upper House", 2, 1), (2025, 11, "Lower House", 2, 1)]
    assert rows_of(cubes, "contributions", "house", "member_source_id", "turns", "subject_name", "proceeding_name")[0] == ("Lower House", "m1", 2, "Harbour Works", "Question Time")


def test_questions_and_subjects(cubes):
    pairs = cubes[0]["qa_pairs"].where("house = 'Upper House'").orderBy("question_words").collect()
    assert [(p.question_member, p.answer_member, p.answered, p.answer_portfolios) for p in pairs] == [("Eve", None, False, None), ("Eve", "Fay", True, '["Ports"]')]
    got = {r.subject_name: r for r in cubes[0]["subject_occurrence"].where("house = 'Upper House'").collect()}
    works, tram = got["Harbour Works"], got["Tram Bill"]
    assert (works.talker_turns, works.distinct_speakers, works.questions, works.interjections, works.divisions, works.bill_names) == (4, 3, 2, 1, 0, None)
    assert (tram.divisions, tram.bill_names, tram.speeches) == (1, "Tram Bill", 1)


def test_divisions_and_bills(cubes):
    assert rows_of(cubes, "division_summary", "house", "margin", "recorded_votes", "tellers", "result") == [("Lower House", 1, 3, 1, "ayes"), ("Upper House", 1, 3, 1, "ayes")]
    detail = {(r.house, r.member_source_id): r for r in cubes[0]["division_votes_detail"].collect()}
    assert detail["Upper House", "m1"].voted_with_result and not detail["Upper House", "m9"].voted_with_result and detail["Lower House", "m9"].member_name == "Guy"
    assert rows_of(cubes, "bill_journey", "date", "bill_key", "stage_labels", "furthest_stage", "divisions") == [(dt.date(2025, 3, 4), "tram bill", "Second Reading", "second_reading", 1), (dt.date(2025, 3, 11), "tram bill", "Third Reading", "third_reading", 1)]
    assert rows_of(cubes, "bills", "bill_key", "houses", "house_names", "latest_stage", "house_days") == [("tram bill", 2, "Lower House, Upper House", "third_reading", 2)]


def test_themes(cubes):
    assert rows_of(cubes, "theme_by_week", "iso_week", "theme_id", "subject_occurrences", "top_rank_occurrences") == [(10, "t1", 1, 1), (10, "t2", 2, 1), (11, "t1", 1, 1), (11, "t2", 1, 0)]
    assert rows_of(cubes, "theme_cooccurrence", "theme_id_a", "theme_id_b", "cooccurrences") == [("t1", "t2", 2)]
    assert rows_of(cubes, "theme_candidates", "house", "subject_name", "reason") == [("Lower House", "Harbour Works", "unclassified"), ("Upper House", "Harbour Works", "low_confidence")]
    assert rows_of(cubes, "theme_share_by_jurisdiction", "theme_id", "subjects", "share_pct") == [("t1", 2, 66.67), ("t2", 1, 33.33)]
    assert rows_of(cubes, "theme_coverage", "total_subjects", "classified_subjects", "classified_pct") == [(4, 3, 75.0)]
    assert ("t1", "m2", 2, 1) in rows_of(cubes, "member_theme_rank", "theme_id", "member_source_id", "turns", "theme_rank")
    assert rows_of(cubes, "bill_theme_link", "bill_key", "theme_id", "subject_occurrences") == [("tram bill", "t1", 2), ("tram bill", "t2", 2)]
    assert ("t1", "m9", "NOES", 2, "Guy") in rows_of(cubes, "member_vote_by_theme", "theme_id", "member_source_id", "vote", "votes", "member_name")
    assert rows_of(cubes, "theme_subject_names", "theme_id", "subject_name", "occurrences") == [("t1", "Tram Bill", 2), ("t2", "Harbour Works", 1)]


def test_days(cubes):
    days = cubes[0]["pipeline_coverage"].orderBy("date").collect()
    assert [(d.house, d.harvested, d.normalized, d.themed, d.embedded, d.raw_documents, d.subjects) for d in days] == [("Upper House", True, True, True, False, 1, 2), ("Lower House", True, True, True, False, 1, 2), (None, True, False, False, False, 3, 0)]
    assert rows_of(cubes, "sitting_days", "house", "duration_minutes", "talker_turns", "distinct_speakers", "divisions", "review_stage") == [("Lower House", 330, 5, 3, 1, "final"), ("Upper House", 330, 5, 3, 1, "final")]


def test_without_enrichment_and_as_a_database(spark, cubes, tmp_path):
    empty = {name: df.limit(0) for name, df in cubes[2].items() if name in ("subject_themes", "members", "stage_vocab", "raw_days")}
    rows = gold.write_cubes(spark, cubes[2] | empty, str(tmp_path / "g"), only=("theme_by_week", "theme_coverage", "theme_share_by_jurisdiction", "pipeline_coverage"))
    assert rows == {"theme_by_week": 0, "theme_share_by_jurisdiction": 0, "theme_coverage": 0, "pipeline_coverage": 2}


def test_bad_files_are_recorded(spark, tmp_path):
    folder = tmp_path / "au" / "2025-03-04" / "reps"
    folder.mkdir(parents=True)
    (folder / "1.xml").write_text("<hansard><nothing/></hansard>")
    (folder / "2.xml").write_text("<broken")
    errors = normalize(raw_files(spark, str(tmp_path)))["parse_errors"].collect()
    assert "2.xml" in {e.name for e in errors} and all(e.house == "reps" and e.error for e in errors)


def test_publish(spark, cubes, tmp_path):
    report = gold.publish(spark, cubes[3], str(tmp_path / "staged"), texts=cubes[2]["texts"], least_coverage=0.5)
    assert set(report) == set(gold.CUBES) and report["bills"]["rows"] == 1 and all(r["bytes"] > 0 for r in report.values())
    assert gold.refresh_card("| `bills` | 12,345 | x |\n| other | 7 |", report) == "| `bills` | 1 | x |\n| other | 7 |"
    with pytest.raises(ValueError):
        gold.publish(spark, cubes[3], str(tmp_path / "s"), texts=cubes[2]["texts"].withColumn("subject_id", F.lit(None)))
