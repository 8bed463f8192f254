"""The cubes over the relational tables of transcripts.

A cube is a function of named frames: the twelve transcript tables, the side
tables (members, subject_themes, stage_vocab, raw_days, embedding_index) and
the cubes before it.  ``frames_of`` binds the names to a folder's tables, and
``write_cubes`` computes all cubes in order, later ones from the files of
earlier ones.  Satellites are aggregated before they are joined.  Where the
latest of several values is asked for, the later turn of a day wins.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstone.functions.columns import count_if, iso_week, joined_distinct, joined_ordered, latest, minutes_between, name_key
from turnstone.operators.windows import next_match, top_n
from turnstone.sources import schemas, tables

Frames = Mapping[str, DataFrame]
CUBES: dict[str, Callable[[Frames], DataFrame]] = {}

DAY = ["jurisdiction", "date", "house"]
MEMBER = ["jurisdiction", "member_source_id"]
MODEL = ["engine", "model"]
#: Kinds of turns that count as contributions, and the score under which a theme is doubtful.
SUBSTANTIVE = ("speech", "question", "answer")
LOW_SCORE = 0.30
NAMES_SHOWN = 10


def cube(f: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    CUBES[f.__name__] = f
    return f


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def _turns(*more: Column, name: str = "turns") -> list[Column]:
    """Counts of turns, by kind, and words."""
    kinds = [count_if(F.col("kind") == kind).alias(column) for kind, column in (("speech", "speeches"), ("question", "questions"), ("answer", "answers"), ("interjection", "interjections"))]
    return [F.count("*").alias(name), *kinds, _total("word_count").alias("words"), *more]


def _newest(value: str, *order: str) -> Column:
    return latest(F.col(value), *(F.col(o) for o in order)).alias("member_name" if value == "name" else value)


def _with_zeros(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna(0, list(columns))


def _register(t: Frames) -> DataFrame:
    return t["members"].select("jurisdiction", F.col("source_member_id").alias("member_source_id"), "display_name", "party_name").dropDuplicates(MEMBER)


def _subject_names(t: Frames) -> DataFrame:
    """Names of subjects and of their proceedings, by subject."""
    proceedings = t["proceedings"].select("proceeding_id", F.col("name").alias("proceeding_name"))
    return t["subjects"].select("subject_id", "proceeding_id", F.col("name").alias("subject_name"), "extract_index").join(proceedings, "proceeding_id", "left").drop("proceeding_id")


def _theme_name() -> Column:
    return F.min("theme_name").alias("theme_name")


def _bill_subjects(t: Frames) -> DataFrame:
    """Subjects about a bill, by a named reference or else by their own name, with the bill's key."""
    named = t["bill_refs"].where("name is not null").groupBy("subject_id").agg(F.min("name").alias("ref_name"))
    subjects = t["subjects"].select(*DAY, "subject_id", "name").join(named, "subject_id", "left").where(F.col("ref_name").isNotNull() | F.col("name").rlike(r"\bBill\b"))
    bill = F.coalesce("ref_name", "name")
    return subjects.select(*DAY, "subject_id", bill.alias("bill_name"), name_key(bill).alias("bill_key"))


@cube
def member_activity(t: Frames) -> DataFrame:
    """Turns and votes of each member; those who only voted have null turn counts."""
    order = ("date", "document_order")
    # Subjects and days are counted from one row each, so no aggregate has two distinct counts.
    turns = t["talkers"].where("member_source_id is not null")
    by_subject = turns.groupBy(*MEMBER, "subject_id", "date").agg(
        *(latest(F.col(c), F.col("date"), F.col("document_order")).alias(c) for c in ("name", "party_abbreviation", "party", "electorate")),
        F.max("document_order").alias("document_order"), *_turns(F.sum("paragraph_count").alias("paragraphs"), F.bool_or("first_speech").alias("first_speech")),
    )
    counts = ("turns", "speeches", "questions", "answers", "interjections", "words", "paragraphs")
    days = by_subject.groupBy(*MEMBER, "date").agg(*(latest(F.col(c), F.col("document_order")).alias(c) for c in ("name", "party_abbreviation", "party", "electorate")), F.max("document_order").alias("document_order"), F.collect_set("subject_id").alias("ids"), *(F.sum(c).alias(c) for c in counts), F.bool_or("first_speech").alias("first_speech"))
    speaking = days.groupBy(*MEMBER).agg(
        *(_newest(c, *order) for c in ("name", "party_abbreviation", "party", "electorate")), *(_total(c).alias(c) for c in counts), F.sum(F.size("ids")).cast("long").alias("subjects"), F.count("*").alias("sitting_days"),
        F.min("date").alias("first_sitting"), F.max("date").alias("last_sitting"), F.bool_or("first_speech").alias("gave_first_speech"),
    )
    voting = t["division_votes"].where("member_source_id is not null").groupBy(*MEMBER).agg(F.count("*").alias("division_votes"), count_if(F.col("vote") == "AYES").alias("votes_ayes"), count_if(F.col("vote") == "NOES").alias("votes_noes"), count_if(F.col("teller")).alias("teller_count"))
    both = speaking.join(voting, MEMBER, "full").join(_register(t), MEMBER, "left")
    both = both.withColumns({"member_name": F.coalesce("member_name", "display_name"), "party": F.coalesce("party", "party_name")}).drop("display_name", "party_name")
    return _with_zeros(both, "division_votes", "votes_ayes", "votes_noes", "teller_count")


@cube
def member_activity_by_week(t: Frames) -> DataFrame:
    year, week = iso_week(F.col("date"))
    order = ("date", "document_order")
    turns = t["talkers"].where("member_source_id is not null")
    return turns.groupBy("jurisdiction", "house", year.alias("iso_year"), week.alias("iso_week"), "member_source_id").agg(
        F.min("date").alias("week_start_sitting"), _newest("name", *order), _newest("party_abbreviation", *order), *_turns(F.countDistinct("subject_id").alias("subjects"), F.countDistinct("date").alias("sitting_days"))
    )


@cube
def contributions(t: Frames) -> DataFrame:
    """One row per subject and member; names are joined to the aggregate."""
    turns = t["talkers"].where("subject_id is not null and member_source_id is not null")
    counted = turns.groupBy(*DAY, "subject_id", "member_source_id").agg(
        _newest("name", "document_order"), _newest("party_abbreviation", "document_order"), _newest("electorate", "document_order"), *_turns(F.min("document_order").alias("first_turn_order"), F.bool_or("first_speech").alias("includes_first_speech"))
    )
    return counted.join(_subject_names(t).drop("extract_index"), "subject_id", "left")


@cube
def qa_pairs(t: Frames) -> DataFrame:
    """Each question with the first answer after it in its subject."""
    turns = t["talkers"].where("subject_id is not null and kind in ('question', 'answer')")
    fields = ["talker_id", "member_source_id", "name", "party_abbreviation", "portfolios", "word_count"]
    paired = next_match(turns.select(*DAY, "subject_id", "document_order", "kind", "start_time", *fields), ["subject_id"], "document_order", F.col("kind") == "answer", fields, "_a_").where("kind = 'question'")
    named = lambda side, prefix: [F.col(prefix + c).alias(f"{side}_{n}") for c, n in (("talker_id", "talker_id"), ("member_source_id", "member_id"), ("name", "member"), ("party_abbreviation", "party"), ("word_count", "words"))]
    out = paired.select(*DAY, "subject_id", *named("question", ""), F.col("start_time").alias("question_time"), *named("answer", "_a_"), F.col("_a_portfolios").alias("answer_portfolios"), F.col("_a_talker_id").isNotNull().alias("answered"))
    return out.join(t["subjects"].select("subject_id", F.col("name").alias("subject_name")), "subject_id", "left")


@cube
def subject_occurrence(t: Frames) -> DataFrame:
    some = lambda name: t[name].where("subject_id is not null")
    turns = some("talkers").groupBy("subject_id").agg(*_turns(F.countDistinct("member_source_id").alias("distinct_speakers"), F.min("start_time").alias("first_spoken_at"), name="talker_turns"))
    divisions = some("divisions").groupBy("subject_id").agg(F.count("*").alias("divisions"))
    bills = some("bill_refs").groupBy("subject_id").agg(joined_ordered(F.col("name"), F.col("name"), "; ").alias("bill_names"))
    proceedings = t["proceedings"].select("proceeding_id", F.col("name").alias("proceeding_name"))
    out = t["subjects"].select(*DAY, "subject_id", "proceeding_id", F.col("name").alias("subject_name"), "extract_index", "document_order").join(proceedings, "proceeding_id", "left")
    for satellite in (turns, divisions, bills):
        out = out.join(satellite, "subject_id", "left")
    return _with_zeros(out, "talker_turns", "distinct_speakers", "speeches", "questions", "answers", "interjections", "words", "divisions")


@cube
def division_summary(t: Frames) -> DataFrame:
    votes = t["division_votes"].groupBy("division_id").agg(F.count("*").alias("recorded_votes"), count_if(F.col("teller")).alias("tellers"), count_if(F.col("proxy")).alias("proxies"))
    counts = ["ayes_count", "noes_count", "pairs_count", "abstentions_count"]
    out = t["divisions"].select(*DAY, "division_id", "subject_id", "result", *counts, "document_order").join(_subject_names(t), "subject_id", "left").join(votes, "division_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return _with_zeros(out.withColumn("margin", F.abs(zero("ayes_count") - zero("noes_count"))), "recorded_votes", "tellers", "proxies")


@cube
def division_votes_detail(t: Frames) -> DataFrame:
    divisions = t["divisions"].select("division_id", "subject_id", F.col("result").alias("division_result")).join(t["subjects"].select("subject_id", F.col("name").alias("subject_name")), "subject_id", "left")
    votes = t["division_votes"].select(*DAY, "division_id", "member_source_id", "member_name", "vote", "teller", "proxy", "party").join(divisions, "division_id", "left").join(_register(t), MEMBER, "left")
    agrees = F.col("vote") == F.upper(F.coalesce("division_result", F.lit("")))
    return votes.withColumns({"voted_with_result": agrees, "member_name": F.coalesce("member_name", "display_name"), "party": F.coalesce("party", "party_name")}).drop("display_name", "party_name")


@cube
def bill_journey(t: Frames) -> DataFrame:
    """What happened to each bill on each day of a house."""
    vocabulary = t["stage_vocab"].select("jurisdiction", F.col("name_lower").alias("label_key"), "stage", "stage_order")
    steps = t["subproceedings"].select("jurisdiction", "subject_id", "name", "document_order", F.lower("name").alias("label_key")).join(vocabulary, ["jurisdiction", "label_key"], "left")
    stages = steps.groupBy("subject_id").agg(joined_ordered(F.col("name"), F.col("document_order"), " · ").alias("labels"), latest(F.col("stage"), F.col("stage_order")).alias("stage"), F.max("stage_order").alias("stage_order"))
    turns = t["talkers"].where("subject_id is not null").groupBy("subject_id").agg(F.count("*").alias("talker_turns"), F.countDistinct("member_source_id").alias("distinct_speakers"), _total("word_count").alias("words"))
    divisions = t["divisions"].where("subject_id is not null").groupBy("subject_id").agg(F.count("*").alias("divisions"), joined_ordered(F.col("result"), F.col("document_order"), ", ").alias("results"))
    bills = _bill_subjects(t)
    for satellite in (stages, turns, divisions):
        bills = bills.join(satellite, "subject_id", "left")
    listed = lambda c, separator, name: joined_ordered(F.col(c), F.col("subject_id"), separator).alias(name)
    return bills.groupBy("jurisdiction", "bill_key", "date", "house").agg(
        F.min("bill_name").alias("bill_name"), listed("labels", " · ", "stage_labels"), latest(F.col("stage"), F.col("stage_order")).alias("furthest_stage"), F.max("stage_order").alias("furthest_stage_order"),
        *(_total(c).alias(c) for c in ("talker_turns", "distinct_speakers", "words", "divisions")), listed("results", ", ", "division_results"),
    )


@cube
def bills(t: Frames) -> DataFrame:
    journey = t["bill_journey"]
    return journey.groupBy("jurisdiction", "bill_key").agg(
        latest(F.col("bill_name"), F.col("date"), F.col("house")).alias("bill_name"), joined_distinct(F.col("house")).alias("house_names"), F.countDistinct("house").alias("houses"), F.min("date").alias("first_sitting"), F.max("date").alias("last_sitting"),
        F.count("*").alias("house_days"), latest(F.col("furthest_stage"), F.col("furthest_stage_order")).alias("latest_stage"), F.max("furthest_stage_order").alias("latest_stage_order"), *(F.sum(c).alias(c) for c in ("talker_turns", "words", "divisions")),
    )


@cube
def theme_by_week(t: Frames) -> DataFrame:
    year, week = iso_week(F.col("date"))
    return t["subject_themes"].groupBy("jurisdiction", "house", *MODEL, year.alias("iso_year"), week.alias("iso_week"), "theme_id").agg(
        F.min("date").alias("week_start_sitting"), _theme_name(), F.count("*").alias("subject_occurrences"), count_if(F.col("rank") == 1).alias("top_rank_occurrences"), F.round(F.avg("score"), 4).alias("avg_score")
    )


@cube
def theme_cooccurrence(t: Frames) -> DataFrame:
    """Pairs within each subject's own themes, which the taxonomy bounds: no self join."""
    sets = t["subject_themes"].groupBy("jurisdiction", *MODEL, "subject_id").agg(F.sort_array(F.collect_set(F.struct("theme_id", "theme_name"))).alias("themes"))
    pairs = F.flatten(F.transform("themes", lambda a, i: F.transform(F.slice(F.col("themes"), i + 2, F.size("themes")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    each = sets.select("jurisdiction", *MODEL, F.explode(pairs).alias("p")).where("p.a.theme_id < p.b.theme_id")
    return each.groupBy("jurisdiction", *MODEL, F.col("p.a.theme_id").alias("theme_id_a"), F.col("p.b.theme_id").alias("theme_id_b")).agg(F.min("p.a.theme_name").alias("theme_name_a"), F.min("p.b.theme_name").alias("theme_name_b"), F.count("*").alias("cooccurrences"))


@cube
def member_theme_rank(t: Frames) -> DataFrame:
    """Turns are counted by subject first, so that themes join to one row of a member and subject."""
    turns = t["talkers"].where("member_source_id is not null and subject_id is not null").where(F.col("kind").isin(*SUBSTANTIVE))
    counted = turns.groupBy("jurisdiction", "subject_id", "member_source_id").agg(latest(F.col("name"), F.col("date"), F.col("document_order")).alias("name"), F.max("date").alias("date"), F.max("document_order").alias("document_order"), F.count("*").alias("turns"), _total("word_count").alias("words"))
    themed = counted.join(t["subject_themes"].select("subject_id", *MODEL, "theme_id", "theme_name"), "subject_id")
    totals = themed.groupBy("jurisdiction", *MODEL, "theme_id", "member_source_id").agg(_theme_name(), _newest("name", "date", "document_order"), F.sum("turns").alias("turns"), F.sum("words").alias("words"))
    return totals.withColumn("theme_rank", F.dense_rank().over(Window.partitionBy("jurisdiction", *MODEL, "theme_id").orderBy(F.desc("turns"))).cast("long"))


@cube
def bill_theme_link(t: Frames) -> DataFrame:
    themed = _bill_subjects(t).join(t["subject_themes"].select("subject_id", *MODEL, "theme_id", "theme_name"), "subject_id")
    return themed.groupBy("jurisdiction", *MODEL, "bill_key", "theme_id").agg(latest(F.col("bill_name"), F.col("date"), F.col("bill_name")).alias("bill_name"), _theme_name(), F.count("*").alias("subject_occurrences"))


@cube
def member_vote_by_theme(t: Frames) -> DataFrame:
    votes = t["division_votes"].where("member_source_id is not null").select(*MEMBER, "date", "division_id", "member_name", "vote")
    themes = t["divisions"].select("division_id", "subject_id").join(t["subject_themes"].select("subject_id", *MODEL, "theme_id", "theme_name"), "subject_id").drop("subject_id")
    counted = votes.join(themes, "division_id").groupBy("jurisdiction", *MODEL, "theme_id", "member_source_id", "vote").agg(_theme_name(), latest(F.col("member_name"), F.col("date"), F.col("member_name")).alias("member_name"), F.count("*").alias("votes"))
    return counted.join(_register(t), MEMBER, "left").withColumn("member_name", F.coalesce("member_name", "display_name")).drop("display_name", "party_name")


@cube
def theme_candidates(t: Frames) -> DataFrame:
    """Subjects of classified days without a first-ranked theme, or with a doubtful one; scores of all engines count."""
    best = t["subject_themes"].where("rank = 1").groupBy("subject_id").agg(F.max("score").alias("best_score"), F.lit(True).alias("_placed"))
    days = t["subject_themes"].select(*DAY).distinct()
    subjects = t["subjects"].select(*DAY, "subject_id", F.col("name").alias("subject_name")).join(days, DAY, "left_semi").join(best, "subject_id", "left")
    reason = F.when(F.col("_placed").isNull(), "unclassified").otherwise("low_confidence")
    return subjects.where(F.col("_placed").isNull() | (F.col("best_score") < LOW_SCORE)).withColumn("reason", reason).drop("_placed")


@cube
def theme_share_by_jurisdiction(t: Frames) -> DataFrame:
    counts = t["theme_by_week"].groupBy(*MODEL, "jurisdiction", "theme_id").agg(_theme_name(), F.sum("top_rank_occurrences").alias("subjects"))
    total = F.sum("subjects").over(Window.partitionBy(*MODEL, "jurisdiction"))
    return counts.withColumn("share_pct", F.round(F.try_divide(F.lit(100.0) * F.col("subjects"), total), 2))


@cube
def theme_coverage(t: Frames) -> DataFrame:
    """Every model in every jurisdiction; both are short lists, so their product is too."""
    keys = [*MODEL, "jurisdiction"]
    labelled = t["subject_themes"].select(*keys, "subject_id").distinct().groupBy(*keys).agg(F.count("subject_id").alias("classified_subjects"))
    totals = t["subjects"].groupBy("jurisdiction").agg(F.countDistinct("subject_id").alias("total_subjects"))
    out = _with_zeros(labelled.select(*MODEL).distinct().crossJoin(totals).join(labelled, keys, "left"), "classified_subjects")
    return out.withColumn("classified_pct", F.round(F.lit(100.0) * F.col("classified_subjects") / F.nullif(F.col("total_subjects"), F.lit(0)), 1))


@cube
def theme_subject_names(t: Frames) -> DataFrame:
    keys = [*MODEL, "jurisdiction", "theme_id"]
    labels = t["subject_themes"].where("rank = 1").select(*keys, "theme_name", "subject_id")
    named = labels.join(t["subjects"].where("name is not null").select("subject_id", "name", "date"), "subject_id").withColumn("subject_key", name_key(F.col("name")))
    counted = named.groupBy(*keys, "subject_key").agg(_theme_name(), latest(F.col("name"), F.col("date"), F.col("name")).alias("subject_name"), F.count("*").alias("occurrences"))
    return top_n(counted, keys, [F.desc("occurrences"), F.col("subject_key")], NAMES_SHOWN).drop("subject_key")


@cube
def pipeline_coverage(t: Frames) -> DataFrame:
    """How far each day came: harvested, normalized, embedded, themed."""
    per_day = lambda name, *aggregates: t[name].groupBy(*DAY).agg(*aggregates)
    count = lambda name: F.count("*").alias(name)
    out = per_day("fragments", F.sum("extract_count").alias("extracts"), F.min("review_stage").alias("review_stage"))
    for satellite in (
        per_day("subjects", count("subjects")), per_day("talkers", count("talker_turns"), _total("word_count").alias("words")), per_day("texts", count("texts")), per_day("divisions", count("divisions")),
        per_day("embedding_index", joined_distinct(F.col("model_slug")).alias("embed_models"), count("embed_vectors")),
        per_day("subject_themes", joined_distinct(F.col("model_slug")).alias("theme_models"), F.countDistinct("subject_id").alias("themed_subjects"), count("theme_labels")),
    ):
        out = out.join(satellite, DAY, "left")
    raw = t["raw_days"].groupBy("jurisdiction", "date").agg(joined_ordered(F.col("house_code"), F.col("house_code"), ", ").alias("raw_houses"), F.sum("documents").alias("raw_documents"), F.max(F.col("harvested_at").try_cast("timestamp")).alias("harvested_at"))
    both = out.join(raw, ["jurisdiction", "date"], "full")
    flags = {"harvested": "raw_houses", "normalized": "house", "embedded": "embed_models", "themed": "theme_models"}
    both = both.withColumns({flag: F.col(c).isNotNull() for flag, c in flags.items()})
    return _with_zeros(both, "subjects", "talker_turns", "words", "texts", "divisions", "embed_vectors", "themed_subjects", "theme_labels").orderBy("jurisdiction", "date", "house")


@cube
def sitting_days(t: Frames) -> DataFrame:
    per = lambda name, *aggregates: t[name].groupBy("fragment_id").agg(*aggregates)
    turns = per("talkers", F.count("*").alias("talker_turns"), F.countDistinct("member_source_id").alias("distinct_speakers"), _total("word_count").alias("words"))
    out = t["fragments"].select(*DAY, "committee_name", "parliament_num", "session_num", "review_stage", "start_time", "end_time", minutes_between(F.col("start_time"), F.col("end_time")).alias("duration_minutes"), "start_page", "end_page", "extract_count", "fragment_id")
    for satellite in (per("subjects", F.count("*").alias("subjects")), turns, per("divisions", F.count("*").alias("divisions"))):
        out = out.join(satellite, "fragment_id", "left")
    return _with_zeros(out, "subjects", "talker_turns", "distinct_speakers", "words", "divisions")


def frames_of(spark: SparkSession, root: str, **side: DataFrame) -> dict[str, DataFrame]:
    """The tables under *root*, empty where there are none; *side* gives side tables from elsewhere."""
    out = {name: tables.scan(spark, f"{root}/{name}", schema) for name, schema in (schemas.TABLES | schemas.SIDE_TABLES).items()} | side
    return {name: df.withColumn("date", F.col("date").cast("date")) if "date" in df.columns else df for name, df in out.items()}


def write_cubes(spark: SparkSession, frames: Mapping[str, DataFrame], out: str, only: Iterable[str] | None = None) -> dict[str, int]:
    """Write each cube under *out*, in order, and return its number of rows."""
    frames, rows = dict(frames), {}
    for name, make in CUBES.items():
        path = f"{out}/{name}.parquet"
        if only is None or name in only:
            make(frames).write.mode("overwrite").parquet(path)
            rows[name] = spark.read.parquet(path).count()
        if tables.exists(spark, path):
            frames[name] = spark.read.parquet(path)
    return rows


def database(spark: SparkSession, out: str, name: str, silver: Mapping[str, DataFrame] | None = None) -> list[str]:
    """A catalog database with a table for each cube under *out* and, if given, ``silver_`` tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    made = {cube: spark.read.parquet(f"{out}/{cube}.parquet") for cube in CUBES if tables.exists(spark, f"{out}/{cube}.parquet")} | {f"silver_{k}": df for k, df in (silver or {}).items()}
    for table, df in made.items():
        df.write.mode("overwrite").saveAsTable(f"`{name}`.`{table}`")
    return list(made)


def publish(spark: SparkSession, out: str, staging: str, least_coverage: float = 0.95, force: bool = False, texts: DataFrame | None = None) -> dict[str, dict[str, int]]:
    """Copy the cubes under *out* to *staging*; rows and bytes of each.

    Given the *texts*, their subjects must be known for *least_coverage* of the
    rows, unless forced.
    """
    if texts is not None:
        tables.require_coverage(texts, "subject_id", least_coverage, force)
    report = {}
    for name in CUBES:
        path, target = f"{out}/{name}.parquet", f"{staging}/{name}.parquet"
        if tables.exists(spark, path):
            spark.read.parquet(path).hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(target)
            report[name] = {"rows": spark.read.parquet(target).count(), "bytes": tables.size(spark, target)}
    return report


def refresh_card(card: str, report: Mapping[str, Mapping[str, int]]) -> str:
    """A data set's card with the row counts of *report* in its table: ``| `name` | 1,234 | ...``."""
    counted = lambda m: f"{m[1]}{report[m[2]]['rows']:,}" if m[2] in report else m[0]
    return re.sub(r"(\|\s*`?(\w+)`?\s*\|\s*)[\d,]+", counted, card)
