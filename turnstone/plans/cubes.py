"""The analytical cubes, over the tables at hand.

Turns are events and conversation turns, subjects are orders, votes are line
items, divisions are orders with their line items, registers are customers
and suppliers, jurisdictions are regions and nations, bill names are part
names and themes are brands.  Each function takes (spark, dir); its SQL stands
beside it.  Satellites are aggregated before they are joined, and registers
are left to the planner, which broadcasts them by their size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstone.functions.columns import count_if, count_set, iso_week, joined_distinct, latest, minutes_between, name_key
from turnstone.operators.windows import next_match, top_n

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registrar(queries: dict, statements: dict) -> Callable:
    """A decorator that registers a query and its SQL; *dates* are registered as ISO text."""

    def make(sql: str | None, dates: tuple[str, ...] = ()) -> Callable:
        def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
            queries[f.__name__] = (lambda spark, sf_dir: f(spark, sf_dir).withColumns({d: F.col(d).cast("string") for d in dates})) if dates else f
            if sql:
                statements[f.__name__] = f"SELECT * REPLACE ({', '.join(f'{d}::VARCHAR AS {d}' for d in dates)}) FROM ({sql})" if dates else sql
            return f

        return register

    return make


cube = registrar(QUERIES, SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cube("""
WITH turns AS (SELECT user_id, count(*) AS turns, count(*) FILTER (event_type = 'view') AS speeches, count(*) FILTER (event_type = 'click') AS questions,
  count(*) FILTER (event_type = 'purchase') AS answers, count(*) FILTER (event_type = 'error') AS interjections, count(DISTINCT event_type) AS kinds,
  count(DISTINCT ts::DATE) AS sitting_days, min(ts::DATE) AS first_sitting, max(ts::DATE) AS last_sitting, bool_or(event_type = 'signup') AS gave_first_speech,
  arg_max(event_type, ts) AS latest_kind FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
votes AS (SELECT o_custkey, count(*) AS division_votes, count(*) FILTER (o_orderstatus = 'O') AS votes_ayes, count(*) FILTER (o_orderstatus = 'F') AS votes_noes FROM orders GROUP BY o_custkey)
SELECT coalesce(t.user_id, v.o_custkey) AS member_id, c_name AS member_name, turns, speeches, questions, answers, interjections, kinds, sitting_days, first_sitting, last_sitting, gave_first_speech, latest_kind,
  coalesce(division_votes, 0) AS division_votes, coalesce(votes_ayes, 0) AS votes_ayes, coalesce(votes_noes, 0) AS votes_noes
FROM turns t FULL JOIN votes v ON t.user_id = v.o_custkey LEFT JOIN customer ON c_custkey = coalesce(t.user_id, v.o_custkey)""", dates=("first_sitting", "last_sitting",))
def member_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and votes by member; members with votes alone keep null turn counts."""
    kind, day = F.col("event_type"), F.to_date("ts")
    turns = read(spark, sf_dir, "events").where("user_id is not null").groupBy(F.col("user_id").alias("member_id")).agg(
        F.count("*").alias("turns"), count_if(kind == "view").alias("speeches"), count_if(kind == "click").alias("questions"), count_if(kind == "purchase").alias("answers"),
        count_if(kind == "error").alias("interjections"), count_set(kind).alias("kinds"), count_set(day).alias("sitting_days"), F.min(day).alias("first_sitting"),
        F.max(day).alias("last_sitting"), F.bool_or(kind == "signup").alias("gave_first_speech"), latest(kind, F.col("ts")).alias("latest_kind"),
    )
    status = F.col("o_orderstatus")
    votes = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("member_id")).agg(F.count("*").alias("division_votes"), count_if(status == "O").alias("votes_ayes"), count_if(status == "F").alias("votes_noes"))
    register = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member_id"), F.col("c_name").alias("member_name"))
    out = turns.join(votes, "member_id", "full").join(register, "member_id", "left")
    return out.fillna(0, ["division_votes", "votes_ayes", "votes_noes"])


@cube("""
SELECT isoyear(ts)::BIGINT AS iso_year, week(ts)::BIGINT AS iso_week, user_id, min(ts::DATE) AS week_start, count(*) AS turns, count(*) FILTER (event_type = 'view') AS speeches,
  count(*) FILTER (event_type = 'click') AS questions, count(DISTINCT ts::DATE) AS sitting_days, arg_max(event_type, ts) AS latest_kind FROM events GROUP BY ALL""", dates=("week_start",))
def activity_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, week = iso_week(F.col("ts"))
    kind, day = F.col("event_type"), F.to_date("ts")
    return read(spark, sf_dir, "events").groupBy(year.alias("iso_year"), week.alias("iso_week"), "user_id").agg(
        F.min(day).alias("week_start"), F.count("*").alias("turns"), count_if(kind == "view").alias("speeches"), count_if(kind == "click").alias("questions"),
        count_set(day).alias("sitting_days"), latest(kind, F.col("ts")).alias("latest_kind"),
    )


@cube("""
WITH c AS (SELECT l_orderkey, l_suppkey, count(*) AS turns, count(*) FILTER (l_returnflag = 'R') AS questions, sum(l_quantity::BIGINT)::BIGINT AS words, min(l_linenumber)::BIGINT AS first_turn,
  bool_or(l_linestatus = 'F') AS includes_first, min(p_brand) AS brand FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT c.*, o_orderdate::DATE AS sitting, o_orderpriority AS proceeding, s_name AS member_name FROM c LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey""", dates=("sitting",))
def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per subject and member; names are joined after the aggregate."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left")
    per = lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.count("*").alias("turns"), count_if(F.col("l_returnflag") == "R").alias("questions"), F.sum(F.col("l_quantity").cast("long")).alias("words"), F.min(F.col("l_linenumber").cast("long")).alias("first_turn"),
        F.bool_or(F.col("l_linestatus") == "F").alias("includes_first"), F.min("p_brand").alias("brand"),
    )
    subjects = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("sitting"), F.col("o_orderpriority").alias("proceeding"))
    register = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("member_name"))
    return per.join(subjects, "l_orderkey", "left").join(register, "l_suppkey", "left")


@cube("""
WITH q AS (SELECT conv_id, turn, length(text)::BIGINT AS question_chars FROM conversations WHERE role = 'user'),
n AS (SELECT q.*, (SELECT min(a.turn) FROM conversations a WHERE a.conv_id = q.conv_id AND a.turn > q.turn AND a.role = 'assistant') AS answer_turn FROM q)
SELECT n.*, length(a.text)::BIGINT AS answer_chars, answer_turn IS NOT NULL AS answered FROM n LEFT JOIN conversations a ON a.conv_id = n.conv_id AND a.turn = n.answer_turn""")
def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question with the first answer after it in the same subject."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("chars"))
    paired = next_match(turns, ["conv_id"], "turn", F.col("role") == "assistant", ["turn", "chars"], "answer_").where("role = 'user'")
    return paired.select("conv_id", "turn", F.col("chars").alias("question_chars"), "answer_turn", "answer_chars", F.col("answer_turn").isNotNull().alias("answered"))


@cube("""
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), p AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT event_id, c.user_id, c.ts, p.ts AS next_ts, p.value AS next_value FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts < p.ts""")
def event_next_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = next_match(read(spark, sf_dir, "events").drop("props"), ["user_id"], "ts", F.col("event_type") == "purchase", ["ts", "value"], "next_")
    return paired.where("event_type = 'click'").select("event_id", "user_id", "ts", "next_ts", "next_value")


@cube("""
WITH t AS (SELECT l_orderkey, count(*) AS turns, count(DISTINCT l_suppkey) AS speakers, count(*) FILTER (l_returnflag = 'N') AS speeches, sum(l_quantity::BIGINT)::BIGINT AS words, min(l_shipdate) AS first_spoken FROM lineitem GROUP BY 1),
d AS (SELECT l_orderkey, count(*) AS divisions FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT l_orderkey, string_agg(DISTINCT p_brand, '; ' ORDER BY p_brand) AS bill_names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT o_orderkey, o_orderpriority, coalesce(turns, 0) AS turns, coalesce(speakers, 0) AS speakers, coalesce(speeches, 0) AS speeches, coalesce(words, 0) AS words, first_spoken, coalesce(divisions, 0) AS divisions, bill_names
FROM orders LEFT JOIN t ON t.l_orderkey = o_orderkey LEFT JOIN d ON d.l_orderkey = o_orderkey LEFT JOIN b ON b.l_orderkey = o_orderkey""")
def subject_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects with three satellites; one shuffle of the lines by subject serves all."""
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left")
    facts = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("turns"), count_set(F.col("l_suppkey")).alias("speakers"), count_if(F.col("l_returnflag") == "N").alias("speeches"), F.sum(F.col("l_quantity").cast("long")).alias("words"),
        F.min("l_shipdate").alias("first_spoken"), count_if(F.col("l_returnflag") == "R").alias("divisions"), joined_distinct(F.col("p_brand"), "; ").alias("bill_names"),
    )
    subjects = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    out = subjects.join(facts, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return out.fillna(0, ["turns", "speakers", "speeches", "words", "divisions"])


@cube("""
WITH v AS (SELECT l_orderkey, count(*) AS recorded_votes, count(*) FILTER (l_returnflag = 'A') AS ayes, count(*) FILTER (l_returnflag = 'N') AS noes, count(*) FILTER (l_linestatus = 'F') AS tellers FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus AS result, ayes, noes, abs(coalesce(ayes, 0) - coalesce(noes, 0)) AS margin, coalesce(recorded_votes, 0) AS recorded_votes, coalesce(tellers, 0) AS tellers,
  CASE WHEN ayes > noes THEN 'ayes' WHEN noes > ayes THEN 'noes' END AS derived_result FROM orders LEFT JOIN v ON l_orderkey = o_orderkey""")
def division_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    votes = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("recorded_votes"), count_if(flag == "A").alias("ayes"), count_if(flag == "N").alias("noes"), count_if(F.col("l_linestatus") == "F").alias("tellers"))
    out = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("result")).join(votes, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    ayes, noes = F.col("ayes"), F.col("noes")
    out = out.withColumn("margin", F.abs(F.coalesce(ayes, F.lit(0)) - F.coalesce(noes, F.lit(0)))).withColumn("derived_result", F.when(ayes > noes, "ayes").when(noes > ayes, "noes"))
    return out.fillna(0, ["recorded_votes", "tellers"])


@cube("""
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(s_name, 'unknown') AS member_name, l_returnflag AS vote, o_orderstatus AS division_result, l_returnflag = upper(coalesce(o_orderstatus, '')) AS voted_with_result,
  l_linestatus = 'F' AS teller, l_quantity FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def votes_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_returnflag").alias("vote"), (F.col("l_linestatus") == "F").alias("teller"))
    divisions = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("division_result"))
    register = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("member_name"))
    out = lines.join(divisions, "l_orderkey", "left").join(register, "l_suppkey", "left")
    return out.withColumn("voted_with_result", F.col("vote") == F.upper(F.coalesce("division_result", F.lit("")))).fillna("unknown", ["member_name"])


#: Fixed stages of the journey cube: a label's place is its order.
STAGES = {"1-URGENT": ("introduction", 1), "2-HIGH": ("second_reading", 2), "3-MEDIUM": ("committee", 3), "4-NOT SPECIFIED": ("third_reading", 4), "5-LOW": ("assent", 5)}
_STAGES_SQL = "(VALUES " + ", ".join(f"('{k.lower()}', '{s}', {o})" for k, (s, o) in STAGES.items()) + ") v(label_key, stage, stage_order)"

_JOURNEY_SQL = f"""
named AS (SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS bill_key, p_name FROM part WHERE regexp_matches(p_name, '(gear|widget|anvil)')),
days AS (SELECT bill_key, p_name, o_orderdate::DATE AS sitting, o_orderkey, o_orderpriority, l_quantity::BIGINT AS q FROM lineitem JOIN named ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey),
journey AS (SELECT bill_key, sitting, min(p_name) AS bill_name, string_agg(DISTINCT o_orderpriority, ' · ' ORDER BY o_orderpriority) AS stage_labels, arg_max(stage, stage_order) AS furthest_stage, max(stage_order)::BIGINT AS furthest_order,
  count(*) AS turns, count(DISTINCT o_orderkey) AS subjects, sum(q)::BIGINT AS words FROM days LEFT JOIN {_STAGES_SQL} ON lower(trim(o_orderpriority)) = label_key GROUP BY bill_key, sitting)"""


@cube(f"WITH {_JOURNEY_SQL} SELECT * FROM journey", dates=("sitting",))
def bill_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages that each bill reached on each day; the vocabulary is a few literal rows."""
    bills = read(spark, sf_dir, "part").where(F.col("p_name").rlike("(gear|widget|anvil)")).select(F.col("p_partkey").alias("l_partkey"), name_key(F.col("p_name")).alias("bill_key"), "p_name")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("sitting"), "o_orderpriority")
    vocabulary = spark.createDataFrame([(k.lower(), s, o) for k, (s, o) in STAGES.items()], "label_key string, stage string, stage_order int")
    days = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("long").alias("q")).join(bills, "l_partkey").join(orders, "l_orderkey")
    staged = days.join(F.broadcast(vocabulary), F.lower(F.trim("o_orderpriority")) == F.col("label_key"), "left")
    return staged.groupBy("bill_key", "sitting").agg(
        F.min("p_name").alias("bill_name"), joined_distinct(F.col("o_orderpriority"), " · ").alias("stage_labels"), latest(F.col("stage"), F.col("stage_order")).alias("furthest_stage"),
        F.max("stage_order").cast("long").alias("furthest_order"), F.count("*").alias("turns"), F.countDistinct("l_orderkey").alias("subjects"), F.sum("q").alias("words"),
    )


@cube(f"""WITH {_JOURNEY_SQL}
SELECT bill_key, min(bill_name) AS bill_name, min(sitting) AS first_sitting, max(sitting) AS last_sitting, count(*) AS house_days, string_agg(DISTINCT furthest_stage, ', ' ORDER BY furthest_stage) AS stages,
  count(DISTINCT furthest_stage) AS n_stages, arg_max(furthest_stage, sitting) AS latest_stage, sum(turns)::BIGINT AS turns, sum(words)::BIGINT AS words FROM journey GROUP BY bill_key""", dates=("first_sitting", "last_sitting",))
def bills_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_journey(spark, sf_dir).groupBy("bill_key").agg(
        F.min("bill_name").alias("bill_name"), F.min("sitting").alias("first_sitting"), F.max("sitting").alias("last_sitting"), F.count("*").alias("house_days"), joined_distinct(F.col("furthest_stage")).alias("stages"),
        F.countDistinct("furthest_stage").alias("n_stages"), latest(F.col("furthest_stage"), F.col("sitting")).alias("latest_stage"), F.sum("turns").alias("turns"), F.sum("words").alias("words"),
    )


def _themed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Line items with the brand as their theme; the line number is the rank."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *columns).join(part, "l_partkey")


@cube("""
SELECT isoyear(l_shipdate)::BIGINT AS iso_year, week(l_shipdate)::BIGINT AS iso_week, p_brand AS theme, min(l_shipdate::DATE) AS week_start, count(*) AS occurrences, count(*) FILTER (l_linenumber = 1) AS top_rank,
  round(avg(l_quantity), 4) AS avg_score FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""", dates=("week_start",))
def theme_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, week = iso_week(F.col("l_shipdate"))
    return _themed(spark, sf_dir, "l_shipdate", "l_quantity").groupBy(year.alias("iso_year"), week.alias("iso_week"), "theme").agg(
        F.min(F.to_date("l_shipdate")).alias("week_start"), F.count("*").alias("occurrences"), count_if(F.col("l_linenumber") == 1).alias("top_rank"), F.round(F.avg("l_quantity"), 4).alias("avg_score")
    )


@cube("""
WITH t AS (SELECT DISTINCT l_orderkey, p_brand AS theme FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT a.theme AS theme_a, b.theme AS theme_b, count(*) AS cooccurrences FROM t a JOIN t b ON a.l_orderkey = b.l_orderkey AND a.theme < b.theme GROUP BY ALL""")
def theme_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs within a subject's own theme set, which the vocabulary bounds: no self join."""
    sets = _themed(spark, sf_dir).groupBy("l_orderkey").agg(F.sort_array(F.collect_set("theme")).alias("themes"))
    pairs = F.flatten(F.transform("themes", lambda a, i: F.transform(F.slice(F.col("themes"), i + 2, F.size("themes")), lambda b: F.struct(a.alias("theme_a"), b.alias("theme_b")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.theme_a", "p.theme_b").agg(F.count("*").alias("cooccurrences"))


@cube("""
SELECT p_brand AS theme, l_suppkey AS member_id, count(*) AS turns, sum(l_quantity::BIGINT)::BIGINT AS words, dense_rank() OVER (PARTITION BY p_brand ORDER BY count(*) DESC)::BIGINT AS theme_rank
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY p_brand, l_suppkey""")
def member_theme_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _themed(spark, sf_dir, "l_returnflag", "l_quantity").where(F.col("l_returnflag").isin("A", "N", "R")).groupBy("theme", F.col("l_suppkey").alias("member_id")).agg(F.count("*").alias("turns"), F.sum(F.col("l_quantity").cast("long")).alias("words"))
    return counts.withColumn("theme_rank", F.dense_rank().over(Window.partitionBy("theme").orderBy(F.col("turns").desc())).cast("long"))


@cube("""
SELECT lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS bill_key, p_brand AS theme, max(p_name) AS bill_name, count(*) AS occurrences FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def bill_theme_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by part first, so that names join to one row a part."""
    counts = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", F.col("p_brand").alias("theme"))
    return counts.join(part, "l_partkey").groupBy(name_key(F.col("p_name")).alias("bill_key"), "theme").agg(F.max("p_name").alias("bill_name"), F.sum("n").alias("occurrences"))


@cube("""
SELECT p_brand AS theme, l_suppkey AS member_id, l_returnflag AS vote, coalesce(min(s_name), 'unknown') AS member_name, count(*) AS votes
FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""")
def member_vote_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _themed(spark, sf_dir, "l_returnflag").groupBy("theme", F.col("l_suppkey").alias("member_id"), F.col("l_returnflag").alias("vote")).agg(F.count("*").alias("votes"))
    register = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("member_id"), F.col("s_name").alias("member_name"))
    return counts.join(register, "member_id", "left").fillna("unknown", ["member_name"])


@cube("""
WITH labelled AS (SELECT l_orderkey, max(l_discount) FILTER (l_linenumber = 1) AS best FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
days AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders JOIN labelled ON l_orderkey = o_orderkey)
SELECT o_orderkey, o_orderdate::DATE AS sitting, best, CASE WHEN l_orderkey IS NULL THEN 'unclassified' ELSE 'low_confidence' END AS reason
FROM orders JOIN days ON d = o_orderdate::DATE LEFT JOIN labelled ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL OR best < 0.03""", dates=("sitting",))
def theme_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects of classified days that lack a label or whose best first-ranked score is low."""
    labelled = read(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_linenumber") == 1, F.col("l_discount"))).alias("best"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("sitting"))
    both = orders.join(labelled, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    days = both.where("l_orderkey is not null").select("sitting").distinct()
    reason = F.when(F.col("l_orderkey").isNull(), "unclassified").otherwise("low_confidence")
    return both.join(days, "sitting", "left_semi").where("l_orderkey is null or best < 0.03").select("o_orderkey", "sitting", "best", reason.alias("reason"))


@cube("""
WITH t AS (SELECT n_regionkey::BIGINT AS region, p_brand AS theme, count(*) AS subjects FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL)
SELECT region, theme, subjects, round(100.0::DOUBLE * subjects / sum(subjects) OVER (PARTITION BY region), 4) AS share_pct FROM t""")
def theme_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _regional(spark, sf_dir)
    total = F.sum("subjects").over(Window.partitionBy("region"))
    return counts.withColumn("share_pct", F.round(F.lit(100.0) * F.col("subjects") / total, 4))


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by region and theme; suppliers' counts come first."""
    counts = _themed(spark, sf_dir).groupBy("l_suppkey", "theme").agg(F.count("*").alias("n"))
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(nation, "s_nationkey")
    return counts.join(supplier, "l_suppkey").groupBy("region", "theme").agg(F.sum("n").alias("subjects"))


@cube("""
WITH m AS (SELECT DISTINCT p_brand AS model FROM part), t AS (SELECT r_regionkey::BIGINT AS region, count(*) AS total FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1),
c AS (SELECT p_brand AS model, n_regionkey::BIGINT AS region, count(DISTINCT l_suppkey) AS classified FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_quantity > 48 GROUP BY ALL)
SELECT m.model, t.region, total, coalesce(classified, 0) AS classified, round(100.0::DOUBLE * coalesce(classified, 0) / nullif(total, 0), 4) AS pct FROM m CROSS JOIN t LEFT JOIN c ON c.model = m.model AND c.region = t.region""")
def theme_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model in every region: both are short lists, so their product is too."""
    models = read(spark, sf_dir, "part").select(F.col("p_brand").alias("model")).distinct()
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(nation, "s_nationkey")
    totals = supplier.groupBy("region").agg(F.count("*").alias("total"))
    seen = _themed(spark, sf_dir, "l_quantity").where("l_quantity > 48").select("l_suppkey", F.col("theme").alias("model")).distinct()
    classified = seen.join(supplier, "l_suppkey").groupBy("model", "region").agg(F.count("*").alias("classified"))
    out = models.crossJoin(totals).join(classified, ["model", "region"], "left").fillna(0, ["classified"])
    return out.withColumn("pct", F.round(F.lit(100.0) * F.col("classified") / F.nullif(F.col("total"), F.lit(0)), 4))


@cube("""
SELECT theme, name, occurrences FROM (SELECT p_brand AS theme, lower(trim(p_name)) AS name, count(*) AS occurrences FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber = 1 GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY theme ORDER BY occurrences DESC, name) <= 10""")
def theme_subject_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read(spark, sf_dir, "lineitem").where("l_linenumber = 1").groupBy("l_partkey").agg(F.count("*").alias("n"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme"), F.lower(F.trim("p_name")).alias("name"))
    named = counts.join(part, "l_partkey").groupBy("theme", "name").agg(F.sum("n").alias("occurrences"))
    return top_n(named, ["theme"], [F.col("occurrences").desc(), F.col("name")], 10)


@cube("""
WITH c AS (SELECT c_nationkey AS k, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1),
o AS (SELECT c_nationkey AS k, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1), l AS (SELECT s_nationkey AS k, count(*) AS lines FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_quantity > 49 GROUP BY 1),
norm AS (SELECT n_nationkey AS k, n_name, customers, suppliers, orders, lines FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN s ON s.k = n_nationkey LEFT JOIN o ON o.k = n_nationkey LEFT JOIN l ON l.k = n_nationkey),
raw AS (SELECT user_id % 30 AS k, count(*) AS documents, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS raw_kinds, max(ts) AS harvested_at FROM events GROUP BY 1)
SELECT coalesce(norm.k, raw.k)::BIGINT AS nation, n_name, raw.k IS NOT NULL AS harvested, norm.k IS NOT NULL AS normalized, coalesce(orders, 0) > 0 AS embedded, coalesce(lines, 0) > 0 AS themed,
  customers, suppliers, orders, lines, documents, raw_kinds, harvested_at FROM norm FULL JOIN raw ON norm.k = raw.k""")
def pipeline_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates per unit, full-joined with the raw side, and one flag per stage."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("k"))
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")).join(customer, "c_custkey").groupBy("k").agg(F.sum("n").alias("orders"))
    lines = read(spark, sf_dir, "lineitem").where("l_quantity > 49").groupBy("l_suppkey").agg(F.count("*").alias("n")).join(supplier, "l_suppkey").groupBy("k").agg(F.sum("n").alias("lines"))
    norm = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    for part in (customer.groupBy("k").agg(F.count("*").alias("customers")), supplier.groupBy("k").agg(F.count("*").alias("suppliers")), orders, lines):
        norm = norm.join(part, "k", "left")
    raw = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 30).alias("k")).agg(F.count("*").alias("documents"), joined_distinct(F.col("event_type")).alias("raw_kinds"), F.max("ts").alias("harvested_at"))
    out = norm.withColumn("normalized", F.lit(True)).withColumn("k", F.col("k").cast("long")).join(raw.withColumn("harvested", F.lit(True)), "k", "full")
    some = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return out.select(F.col("k").alias("nation"), "n_name", yes("harvested"), yes("normalized"), some("orders").alias("embedded"), some("lines").alias("themed"), "customers", "suppliers", "orders", "lines", "documents", "raw_kinds", "harvested_at")


@cube("""
SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, date_diff('minute', min(ts), max(ts)) AS duration_minutes, count(*) AS turns, count(DISTINCT event_type) AS kinds, count(DISTINCT ts::DATE) AS days FROM events GROUP BY user_id""")
def sitting_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = read(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("turns"), count_set(F.col("event_type")).alias("kinds"), count_set(F.to_date("ts")).alias("days"))
    return facts.withColumn("duration_minutes", minutes_between(F.col("start_time"), F.col("end_time")))
