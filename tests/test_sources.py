import pytest
from pyspark.sql import functions as F

from turnstone.sources import sqltool, tables
from turnstone.sources.schemas import PARTITIONS, TABLES
from turnstone.sources.transcripts import normalize, raw_files, write_tables
from turnstone.streaming.ingest import ingest

FIRST = """<hansard id="d1" schemaVersion="1" xml:lang="en-AU"><name>Lower House</name><house>Lower House</house><startTime time="2025-05-06T22:00:00"/><endTime time="2025-05-06T02:00:00"/>
<startPage num="10"/><proceeding uid="p1"><name>Questions</name><subject uid="s1"><name>Bridges</name><text id="t1"><heading>Bridges</heading></text>
<talker id="m1" uid="k1" kind="question"><name>Ann</name><startTime time="2025-05-06T22:10:00"/><page num="11"/><text id="t2"><by>Ann:</by> Will it   hold?</text></talker>
<talker id="m2" uid="k2" kind="answer"><name>Bo</name><startTime time="2025-05-06T00:05:00"/><text id="t3">Yes &amp;amp; no.<event kind="interjection" id="m3">Cy</event></text></talker>
<talker id="m1" uid="k3"><name>Ann</name><text id="t4">And then?</text></talker></subject></proceeding></hansard>"""
SECOND = """<hansard id="d2"><name>Lower House</name><house>Lower House</house><proceeding uid="p1" continued="true"><name>Questions</name><text id="t1">again</text>
<subject uid="s2"><name>Ferry Bill</name><bills><bill id="b1" uid="u1">Ferry Bill</bill></bills><division uid="v1"><ayesCount num="2"/><noesCount num="1"/>
<data><member id="m1" vote="ayes" name="Ann"/><member id="m2" vote="ayes" name="Bo (teller)"/><member id="m3" vote="noes" name="Cy"/></data></division></subject></proceeding></hansard>"""


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    day = root / "wa" / "2025-05-06" / "lh"
    day.mkdir(parents=True)
    (day / "1.xml").write_text(FIRST)
    (day / "2.xml").write_text(SECOND)
    (day / "3.xml").write_text("<broken")
    (day / "meta.json").write_text('{"event": {"url": "http://x"}, "documents": 2, "harvested_at": "2025-05-07T00:00:00+00:00"}')
    return root


@pytest.fixture(scope="module")
def silver(spark, raw):
    return {k: v.collect() for k, v in normalize(raw_files(spark, str(raw))).items()}


def test_tables_of_a_day(silver):
    counts = {k: len(v) for k, v in silver.items() if v}
    assert counts == {"fragments": 1, "proceedings": 1, "subjects": 2, "talkers": 4, "texts": 4, "divisions": 1, "division_votes": 3, "bill_refs": 1, "parse_errors": 1}
    talkers = sorted(silver["talkers"], key=lambda r: r.document_order)
    assert [(t.member_source_id, t.kind, t.kind_inferred) for t in talkers] == [("m1", "question", False), ("m2", "answer", False), ("m3", "interjection", False), ("m1", "question", True)]
    assert [t.word_count for t in talkers] == [3, 3, 0, 2]
    assert talkers[1].clock_rolled and talkers[1].start_time > talkers[0].start_time and not talkers[0].clock_rolled
    division = silver["divisions"][0]
    assert (division.result, division.ayes_count, division.noes_count) == ("ayes", 2, 1)
    votes = {v.member_source_id: (v.vote, v.teller, v.member_name) for v in silver["division_votes"]}
    assert votes["m2"] == ("AYES", True, "Bo") and votes["m3"][0] == "NOES"
    header = silver["fragments"][0]
    assert header.extract_count == 2 and header.source_url == "http://x" and header.end_time > header.start_time
    assert {t.clean_text for t in silver["texts"]} >= {"Will it hold?", "Yes & no.", "And then?"}
    assert next(t for t in silver["texts"] if t.source_id == "t3").page_no == "11"
    assert all(s.proceeding_id for s in silver["subjects"]) and all(t.subject_id and t.proceeding_id is None for t in talkers)


def test_rewrite_replaces_one_partition(spark, raw, tmp_path):
    root = str(tmp_path / "silver")
    write_tables({k: v for k, v in normalize(raw_files(spark, str(raw))).items() if k in ("talkers", "subjects")}, root)
    again = spark.read.parquet(f"{root}/subjects").withColumn("date", F.lit("2025-05-08"))
    tables.overwrite_partitions(again, f"{root}/subjects", PARTITIONS)
    tables.overwrite_partitions(again.limit(1), f"{root}/subjects", PARTITIONS)
    assert sorted(r["count"] for r in spark.read.parquet(f"{root}/subjects").groupBy("date").count().collect()) == [1, 2]
    assert tables.scan(spark, f"{root}/clauses", TABLES["clauses"]).count() == 0


def test_stream_ingest(spark, raw, tmp_path):
    query = ingest(spark, str(raw), str(tmp_path / "t"), str(tmp_path / "c"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "t" / "talkers")).count() == 4


def test_raw_days_and_guards(spark, raw):
    assert [(r.jurisdiction, r.house_code, r.documents) for r in tables.raw_days(spark, str(raw)).collect()] == [("wa", "lh", 2)]
    frame = spark.createDataFrame([(1,), (None,)], "x int")
    assert tables.require_coverage(frame, "x", 0.5) == 0.5
    with pytest.raises(ValueError):
        tables.require_coverage(frame, "x")


@pytest.mark.parametrize("bad", ["drop table x", "select 1; select 2", "insert into x select 1", "with a as (select 1) insert into t select * from a"])
def test_sql_guard_rejects(bad):
    with pytest.raises(ValueError):
        sqltool.check_statement(bad)


def test_sql_guard_runs(spark):
    assert sqltool.read_only(spark, "select ';' as x;").first().x == ";"
