import datetime as dt
import uuid

from pyspark.sql import functions as F

from turnstone.functions import columns
from turnstone.operators.windows import last_known, next_match, running_clock


def test_deterministic_id(spark):
    rows = [("a", 1), (None, 2), ("é", None)]
    got = spark.createDataFrame(rows, "x string, y int").select("x", "y", columns.deterministic_id(F.col("x"), F.col("y")).alias("id")).collect()
    for r in got:
        name = "\x1f".join("\x00" if v is None else str(v) for v in (r.x, r.y))
        assert r.id == str(uuid.uuid5(columns.NAMESPACE, name))


def test_text_columns(spark):
    row = spark.createDataFrame([("  a b \n",)], "t string").select(columns.squeeze(F.col("t")).alias("s"), columns.word_count(F.col("t")).alias("n"), columns.slug(F.lit("a b/c")).alias("g")).first()
    assert (row.s, row.n, row.g) == ("a b", 2, "a-b-c")


def test_minutes_cross_boundaries(spark):
    frame = spark.createDataFrame([(dt.datetime(2025, 1, 1, 10, 0, 59), dt.datetime(2025, 1, 1, 10, 1))], "a timestamp, b timestamp")
    assert frame.select(columns.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_latest_skips_nulls(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "o int, v string")
    assert frame.agg(columns.latest(F.col("v"), F.col("o"))).first()[0] == "a"
    joined = frame.agg(columns.joined_ordered(F.col("v"), F.col("o"), "|")).first()[0]
    assert joined == "a"


def test_next_and_last(spark):
    frame = spark.createDataFrame([(1, i, k) for i, k in enumerate(["q", None, "a", "q"])], "g int, o int, k string")
    got = {r.o: (r.next_o, r.before) for r in last_known(next_match(frame, ["g"], "o", F.col("k") == "a", ["o"], "next_"), ["g"], "o", F.col("k"), "before").collect()}
    assert got == {0: (2, None), 1: (2, "q"), 2: (None, "q"), 3: (None, "a")}


def test_clock_rolls_past_midnight(spark):
    clocks = ["22:00", "23:30", "00:10", "01:00", None, "00:50"]
    rows = [(1, i, None if c is None else dt.datetime.fromisoformat(f"2025-01-01T{c}")) for i, c in enumerate(clocks)]
    got = [r.days_rolled for r in running_clock(spark.createDataFrame(rows, "g int, o long, c timestamp"), ["g"], "o", "c").orderBy("o").collect()]
    assert got == [0, 0, 1, 1, 1, 1]
