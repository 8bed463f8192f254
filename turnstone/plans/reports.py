"""Report queries over the cubes, and the operators registered on the tables at hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstone.functions.columns import NAMESPACE, count_if, deterministic_id, iso_week, minutes_between, squeeze, word_count
from turnstone.operators import enrich, vectors
from turnstone.operators.windows import last_known, running_clock, top_n
from turnstone.sources import register

from .cubes import _JOURNEY_SQL, _regional, bill_journey, read, registrar, theme_by_week

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


report = registrar(QUERIES, SQL)


_REGIONAL = "SELECT n_regionkey::BIGINT AS region, p_brand AS theme, count(*) AS subjects FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL"
_SHARES = f"t AS ({_REGIONAL}), s AS (SELECT *, 100.0::DOUBLE * subjects / sum(subjects) OVER (PARTITION BY region) AS share FROM t)"


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum("subjects").over(Window.partitionBy("region"))
    return _regional(spark, sf_dir).withColumn("share", F.lit(100.0) * F.col("subjects") / total)


@report(f"""WITH {_SHARES}, g AS (SELECT theme, count(*) AS regions, round(min(share), 4) AS least, round(avg(share), 4) AS mean, round(stddev_pop(share) / nullif(avg(share), 0), 4) AS cv FROM s GROUP BY theme
  HAVING count(*) = (SELECT count(DISTINCT region) FROM s))
SELECT * FROM g ORDER BY cv, theme LIMIT 15""")
def report_common_ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes of every region with the least relative spread of their shares."""
    shares = _shares(spark, sf_dir)
    everywhere = shares.agg(F.countDistinct("region").alias("_all"))
    spread = shares.groupBy("theme").agg(F.count("*").alias("regions"), F.round(F.min("share"), 4).alias("least"), F.round(F.avg("share"), 4).alias("mean"), F.round(F.try_divide(F.stddev_pop("share"), F.avg("share")), 4).alias("cv"))
    return spread.join(F.broadcast(everywhere), F.col("regions") == F.col("_all")).drop("_all").orderBy("cv", "theme").limit(15)


@report(f"""WITH t AS ({_REGIONAL}), a AS (SELECT theme, sum(subjects) AS n, sum(sum(subjects)) OVER () AS total FROM t GROUP BY theme), r AS (SELECT *, sum(subjects) OVER (PARTITION BY region) AS of FROM t)
SELECT region, theme, subjects, round((subjects::DOUBLE / of) / (n::DOUBLE / total), 4) AS lift FROM r JOIN a USING (theme) QUALIFY row_number() OVER (PARTITION BY region ORDER BY round((subjects::DOUBLE / of) / (n::DOUBLE / total), 4) DESC, theme) <= 5""")
def report_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five themes most typical of each region: share there over share everywhere."""
    counts = _regional(spark, sf_dir)
    overall = counts.groupBy("theme").agg(F.sum("subjects").alias("n"))
    total = overall.agg(F.sum("n").alias("total"))
    lift = (F.col("subjects").cast("double") / F.sum("subjects").over(Window.partitionBy("region"))) / (F.col("n").cast("double") / F.col("total"))
    scored = counts.join(overall.crossJoin(F.broadcast(total)), "theme").select("region", "theme", "subjects", F.round(lift, 4).alias("lift"))
    return top_n(scored, ["region"], [F.col("lift").desc(), F.col("theme")], 5)


_WEEKS = "w AS (SELECT isoyear(l_shipdate)::BIGINT AS iso_year, week(l_shipdate)::BIGINT AS iso_week, p_brand AS theme, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)"


@report(f"WITH {_WEEKS} SELECT iso_year, iso_week, theme, n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY iso_year, iso_week), 4) AS share FROM w")
def report_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = theme_by_week(spark, sf_dir).select("iso_year", "iso_week", "theme", F.col("occurrences").alias("n"))
    return weeks.withColumn("share", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("iso_year", "iso_week")), 4))


@report(f"WITH {_WEEKS} SELECT theme, max(n) AS peak, arg_max(iso_year * 100 + iso_week, n * 1000000 - (iso_year * 100 + iso_week)) AS peak_week, sum(n)::BIGINT AS total FROM w GROUP BY theme")
def report_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each theme's busiest week, the earliest of several."""
    week = F.col("iso_year") * 100 + F.col("iso_week")
    return theme_by_week(spark, sf_dir).groupBy("theme").agg(F.max("occurrences").alias("peak"), F.max_by(week, F.struct(F.col("occurrences"), -week)).alias("peak_week"), F.sum("occurrences").alias("total"))


@report("SELECT count(DISTINCT ts::DATE) AS days, count(*) AS turns, count(DISTINCT user_id) AS members, round(sum(value), 2) AS volume FROM events")
def report_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").agg(F.countDistinct(F.to_date("ts")).alias("days"), F.count("*").alias("turns"), F.countDistinct("user_id").alias("members"), F.round(F.sum("value"), 2).alias("volume"))


@report("SELECT isoyear(ts) || '-W' || lpad(week(ts)::VARCHAR, 2, '0') AS week, count(*) AS turns FROM events GROUP BY 1")
def report_week_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, week = iso_week(F.col("ts"))
    return read(spark, sf_dir, "events").groupBy(F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0")).alias("week")).agg(F.count("*").alias("turns"))


@report("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_name LIKE '%9%' AND c_mktsegment LIKE '%' AND c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 15")
def report_like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").where("c_name like '%9%' and c_mktsegment like '%' and c_acctbal > 0")
    return rows.select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(15)


@report("""SELECT coalesce(event_type, 'none') AS kind, count(*) AS turns, count(*) FILTER (value > 50) AS large, round(100.0::DOUBLE * count(*) FILTER (value > 50) / count(*), 1) AS large_pct, round(avg(value), 3) AS mean FROM events GROUP BY 1""")
def report_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = count_if(F.col("value") > 50)
    return read(spark, sf_dir, "events").groupBy(F.coalesce("event_type", F.lit("none")).alias("kind")).agg(F.count("*").alias("turns"), large.alias("large"), F.round(F.lit(100.0) * large / F.count("*"), 1).alias("large_pct"), F.round(F.avg("value"), 3).alias("mean"))


@report("""WITH s AS (SELECT l_partkey, min(l_shipdate::DATE) AS first_day, max(l_shipdate::DATE) AS last_day, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT p_name || ' (' || l_partkey || ')' AS label, first_day, last_day, lines FROM s JOIN part ON p_partkey = l_partkey WHERE year(first_day) <= 1996 AND year(last_day) >= 1995""", dates=("first_day", "last_day"))
def report_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills whose span of days overlaps the years asked for."""
    day = F.to_date("l_shipdate")
    spans = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("lines")).where("year(first_day) <= 1996 and year(last_day) >= 1995")
    named = spans.join(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    return named.select(F.concat("p_name", F.lit(" ("), F.col("l_partkey").cast("string"), F.lit(")")).alias("label"), "first_day", "last_day", "lines")


@report("""SELECT p_brand AS theme, l_suppkey AS member_id, count(*) AS turns FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand, l_suppkey QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, l_suppkey) <= 5""")
def report_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme"))
    counts = read(spark, sf_dir, "lineitem").join(part, "l_partkey").groupBy("theme", F.col("l_suppkey").alias("member_id")).agg(F.count("*").alias("turns"))
    return top_n(counts, ["theme"], [F.col("turns").desc(), F.col("member_id")], 5)


@report("SELECT DISTINCT n_regionkey::BIGINT AS region, year(o_orderdate)::BIGINT AS year FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def report_pickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions and years to choose from."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nation, "c_nationkey")
    years = read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("year")).distinct()
    return years.join(customers, "o_custkey").select("region", "year").distinct()


@report("""WITH b AS (SELECT p_name, year(min(o_orderdate))::BIGINT AS year FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY p_name) SELECT year, count(*) AS bills FROM b GROUP BY year""")
def report_bills_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills by the year in which they first came up; days are taken by part first."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    first = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(orders, "l_orderkey").groupBy("l_partkey").agg(F.min("o_orderdate").alias("day"))
    names = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return first.join(names, "l_partkey").groupBy("p_name").agg(F.year(F.min("day")).cast("long").alias("year")).groupBy("year").agg(F.count("*").alias("bills"))


@report(f"""WITH {_JOURNEY_SQL} SELECT sitting, furthest_stage, stage_labels, turns, words FROM journey WHERE bill_key = 'hot anvil'""", dates=("sitting",))
def report_journey(spark: SparkSession, sf_dir: str, bill_key: str = "hot anvil") -> DataFrame:
    """The journey of one bill."""
    return bill_journey(spark, sf_dir).where(F.col("bill_key") == bill_key).select("sitting", "furthest_stage", "stage_labels", "turns", "words")


@report("""SELECT year(o_orderdate)::BIGINT AS year, count(*) AS divisions, count(*) FILTER (o_orderstatus = 'O') AS carried, max(o_totalprice) AS largest FROM orders GROUP BY 1""")
def report_divisions_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.count("*").alias("divisions"), count_if(F.col("o_orderstatus") == "O").alias("carried"), F.max("o_totalprice").alias("largest"))


@report("""SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'Aye' WHEN 'N' THEN 'No' ELSE 'Other' END AS vote, coalesce(s_name, 'unknown') || ' (' || l_linenumber || ')' AS member, l_linestatus = 'F' AS teller
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20)""")
def report_division_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who voted how in the twenty latest divisions."""
    latest = read(spark, sf_dir, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(20).select(F.col("o_orderkey").alias("l_orderkey"))
    votes = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus").join(F.broadcast(latest), "l_orderkey", "left_semi")
    named = votes.join(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey", "left")
    vote = F.when(F.col("l_returnflag") == "A", "Aye").when(F.col("l_returnflag") == "N", "No").otherwise("Other")
    member = F.concat(F.coalesce("s_name", F.lit("unknown")), F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit(")"))
    return named.select("l_orderkey", vote.alias("vote"), member.alias("member"), (F.col("l_linestatus") == "F").alias("teller"))


@report("""WITH s AS (SELECT ts::DATE AS day, date_diff('minute', min(ts), max(ts)) AS minutes, count(*) AS turns FROM events GROUP BY 1) SELECT strftime(day, '%Y-%m-%d') || ' house' AS label, round(minutes / 60.0::DOUBLE, 1) AS hours, turns FROM s""")
def report_sittings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and volume of each sitting day."""
    days = read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("turns"))
    return days.select(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" house")).alias("label"), F.round(minutes_between(F.col("a"), F.col("b")) / F.lit(60.0), 1).alias("hours"), "turns")


@report("""WITH w AS (SELECT p_brand AS theme, isoyear(l_shipdate) * 100 + week(l_shipdate) AS week, avg(l_quantity) AS score, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT theme, sum(n)::BIGINT AS total, round(avg(score), 6) AS mean_of_means FROM w GROUP BY theme ORDER BY total DESC, theme LIMIT 30""")
def report_top_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty largest themes, with the mean of their weekly means."""
    year, week = iso_week(F.col("l_shipdate"))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme"))
    weeks = read(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity").join(part, "l_partkey").groupBy("theme", (year * 100 + week).alias("week")).agg(F.avg("l_quantity").alias("score"), F.count("*").alias("n"))
    return weeks.groupBy("theme").agg(F.sum("n").alias("total"), F.round(F.avg("score"), 6).alias("mean_of_means")).orderBy(F.col("total").desc(), "theme").limit(30)


@report("""WITH c AS (SELECT p_brand AS theme, l_returnflag AS vote, l_suppkey AS member_id, count(*) AS votes FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#11', 'Brand#12', 'Brand#13') GROUP BY ALL)
SELECT theme, vote, member_id, votes FROM c QUALIFY row_number() OVER (PARTITION BY theme ORDER BY votes DESC, member_id, vote) <= 25""")
def report_theme_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 members who voted most on each of the chosen themes."""
    part = read(spark, sf_dir, "part").where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#11", "Brand#12", "Brand#13")).select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme"))
    counts = read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").join(part, "l_partkey").groupBy("theme", F.col("l_returnflag").alias("vote"), F.col("l_suppkey").alias("member_id")).agg(F.count("*").alias("votes"))
    return top_n(counts, ["theme"], [F.col("votes").desc(), F.col("member_id"), F.col("vote")], 25)


@report("""WITH c AS (SELECT n_regionkey::BIGINT AS region, p_name AS name, count(*) AS occurrences FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL)
SELECT region, name, occurrences FROM c QUALIFY row_number() OVER (PARTITION BY region ORDER BY occurrences DESC, name) <= 5""")
def report_framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subject names most used in each region, counted by supplier and part first."""
    counts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("long").alias("region"))
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(nation, "s_nationkey")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name"))
    named = counts.join(supplier, "l_suppkey").join(part, "l_partkey").groupBy("region", "name").agg(F.sum("n").alias("occurrences"))
    return top_n(named, ["region"], [F.col("occurrences").desc(), F.col("name")], 5)


@report("""WITH l AS (SELECT l_orderkey, max(l_discount) FILTER (l_linenumber = 1) AS best FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT year(o_orderdate)::BIGINT AS year, count(*) AS subjects, count(*) FILTER (l_orderkey IS NULL) AS unclassified, count(*) FILTER (best < 0.03) AS low_confidence FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""")
def report_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many subjects of each year lack a theme, or have a doubtful one."""
    labelled = read(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_linenumber") == 1, F.col("l_discount"))).alias("best"))
    both = read(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("year")).join(labelled, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return both.groupBy("year").agg(F.count("*").alias("subjects"), count_if(F.col("l_orderkey").isNull()).alias("unclassified"), count_if(F.col("best") < 0.03).alias("low_confidence"))


# --- vectors --------------------------------------------------------------------------------------

_COSINE = "round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 5)"


@report(f"""SELECT v.vec_id, v.label, {_COSINE} AS score, d.lang, d.source FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q LEFT JOIN documents d ON d.doc_id = v.vec_id
ORDER BY score DESC, vec_id LIMIT 20""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows most similar to one query vector; their documents are joined after the cut."""
    every = read(spark, sf_dir, "embeddings")
    hits = vectors.top_k(every, every.where("vec_id = 0"), 20).select("vec_id", "label", "score")
    names = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "lang", "source")
    return names.join(F.broadcast(hits), "vec_id", "right")


@report("""WITH p AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), c AS (SELECT label, i, avg(x) AS x FROM p GROUP BY ALL),
q AS (SELECT label AS theme, list(x ORDER BY i) AS embedding FROM c GROUP BY label)
SELECT v.vec_id, q.theme AS label, row_number() OVER (PARTITION BY v.vec_id ORDER BY round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding), 5) DESC, q.theme) AS rank, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding), 5) AS score
FROM embeddings v, q WHERE round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding), 5) >= 0.25 QUALIFY rank <= 3""")
def vector_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three themes of each vector, by similarity to the labels' centroids."""
    every = read(spark, sf_dir, "embeddings")
    return vectors.classify(every, vectors.centroids(every), "vec_id", "label")


@report(f"""WITH h AS (SELECT v.vec_id, v.label, {_COSINE} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY score DESC, vec_id LIMIT 40)
SELECT vec_id, score, CASE WHEN label < 3 THEN 0 WHEN label < 7 THEN 1 ELSE 2 END::BIGINT AS tier FROM h ORDER BY tier, score DESC, vec_id LIMIT 10""")
def vector_rerank_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over-fetch, then order by tier before score."""
    every = read(spark, sf_dir, "embeddings")
    hits = vectors.top_k(every, every.where("vec_id = 0"), 40)
    tier = F.when(F.col("label") < 3, 0).when(F.col("label") < 7, 1).otherwise(2)
    return vectors.rerank(hits, tier, 10, "vec_id").select("vec_id", "score", "tier")


@report(None)
def vector_lsh_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate neighbours of every vector whose id is divisible by 50."""
    every = read(spark, sf_dir, "embeddings")
    return vectors.lsh_top_k(every, every.where("vec_id % 50 = 0"), 10)


# --- feeds, freshness, text ----------------------------------------------------------------------


@report("""WITH b AS (SELECT l_orderkey, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT o_orderkey, c_name, n_name, r_name, names, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS held_at FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN b ON l_orderkey = o_orderkey""")
def index_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The citation row of each subject: a chain of left joins, small tables first joined to one another."""
    places = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    members = read(spark, sf_dir, "customer").join(places, "c_nationkey", "left").select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name", "r_name")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    names = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.sort_array(F.collect_set("p_brand")), ",").alias("names"))
    held = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("held_at")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", held).join(members, "o_custkey", "left").join(names, "o_orderkey", "left").drop("o_custkey")


@report("SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def prune_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = read(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("vec_id"))
    return read(spark, sf_dir, "embeddings").select("vec_id", "label").join(kept, "vec_id", "left_anti")


_HALF = "sum(('0x' || substr(r, {0}, 15))::UBIGINT::HUGEINT)::VARCHAR"
_SIGN = f"SELECT source, concat_ws('-', {_HALF.format(1)}, {_HALF.format(16)}, count(*)::VARCHAR) AS signature, count(*) AS texts FROM (SELECT source, md5(doc_id || chr(0) || md5(coalesce(text, ''))) AS r FROM documents {{0}}) GROUP BY source"


@report(f"WITH now AS ({_SIGN.format('')}), stored AS ({_SIGN.format('WHERE doc_id % 97 <> 5')}) SELECT now.source, now.signature, now.texts FROM now LEFT JOIN stored ON stored.source = now.source AND stored.signature = now.signature WHERE stored.source IS NULL")
def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions whose content signature isn't among the stored ones."""

    def signed(docs: DataFrame) -> DataFrame:
        signed = enrich.signatures(docs.select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text")), ["source"], "doc_id", F.col("text"))
        return signed.withColumn("texts", F.substring_index("signature", "-", -1).cast("long"))

    docs = read(spark, sf_dir, "documents")
    return enrich.stale(signed(docs), signed(docs.where("doc_id % 97 <> 5")), ["source"])


@report(r"""WITH m AS (SELECT doc_id, regexp_extract_all(lower(text), 'apache license|mit license|general public license|version [0-9]|licensed') AS found FROM documents),
u AS (SELECT doc_id, generate_subscripts(found, 1) AS i, unnest(found) AS theme FROM m), f AS (SELECT doc_id, theme, min(i) AS i FROM u GROUP BY ALL)
SELECT doc_id, theme, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rank FROM f QUALIFY rank <= 3""")
def llm_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known ids in a model's answer, in order of first occurrence, the first three."""
    found = F.slice(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("apache license|mit license|general public license|version [0-9]|licensed"), 0)), 1, 3)
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(found).alias("i", "theme"))
    return rows.select("doc_id", "theme", (F.col("i") + 1).cast("long").alias("rank"))


@report("""SELECT conv_id, conv_id || chr(10) || substr(string_agg(text, ' ' ORDER BY turn) FILTER (trim(text) <> ''), 1, 1500) AS document FROM conversations GROUP BY conv_id HAVING count(*) FILTER (trim(text) <> '') > 0""")
def theme_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text by which each subject is classified."""
    turns = read(spark, sf_dir, "conversations").withColumn("name", F.col("conv_id"))
    return enrich.theme_documents(turns, "conv_id", "name", "turn", "text")


@report(None)
def embed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector for each turn, by the deterministic embedder."""
    turns = read(spark, sf_dir, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("text_id"), "text")
    return enrich.embed_texts(turns, enrich.hashing_embedder(), "text_id", "text")


@report(r"""SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS clean_md5, CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ')) END::BIGINT AS words FROM documents""")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(squeeze(F.col("text"))).alias("clean_md5"), word_count(F.col("text")).cast("long").alias("words"))


@report("""WITH c AS (SELECT user_id, event_id, '2000-01-01'::DATE + ts::TIME AS clock FROM events),
d AS (SELECT *, last_value(clock IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT user_id, event_id, date_trunc('second', clock) AS clock FROM c)),
r AS (SELECT *, least(2, count(*) FILTER (WHERE before - clock > INTERVAL 12 HOURS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS days_rolled FROM d)
SELECT user_id, event_id, strftime(clock + to_days(days_rolled::INT), '%Y-%m-%d %H:%M:%S') AS rolled, days_rolled FROM r""")
def running_clock_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times cut to their clock and rolled past midnight again, by user."""
    events = read(spark, sf_dir, "events")
    clock = F.to_timestamp_ntz(F.concat(F.lit("2000-01-01 "), F.date_format("ts", "HH:mm:ss")))
    rolled = running_clock(events.select("user_id", "event_id", clock.alias("clock")), ["user_id"], "event_id", "clock")
    return rolled.withColumn("rolled", F.date_format("rolled", "yyyy-MM-dd HH:mm:ss"))


@report("""WITH k AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN role END AS known FROM conversations)
SELECT conv_id, turn, coalesce(known, last_value(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS kind, known IS NULL AS kind_inferred FROM k""")
def kind_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns without a kind take the last known one of their container."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.col("role")).alias("known"))
    filled = last_known(turns, ["conv_id"], "turn", F.col("known"), "before")
    return filled.select("conv_id", "turn", F.coalesce("known", "before").alias("kind"), F.col("known").isNull().alias("kind_inferred"))


@report("""SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS last_error FROM events""")
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "error", F.col("value")).alias("e"))
    return last_known(events, ["user_id"], "ts", F.col("e"), "last_error", inclusive=True).select("event_id", "last_error")


@report("SELECT 1::BIGINT AS present, NULL::VARCHAR AS theme, NULL::BIGINT AS n")
def presence_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty relation still gives one row, with its columns null."""
    empty = read(spark, sf_dir, "part").where("p_size < 0").groupBy(F.col("p_brand").alias("theme")).agg(F.count("*").alias("n"))
    return spark.range(1).select(F.lit(1).cast("long").alias("present")).join(empty, F.lit(True), "left")


@report("SELECT count(*) AS rows, count(o_custkey) AS customers, count(c_custkey) AS matched, round(count(c_custkey)::DOUBLE / count(*), 4) AS coverage FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def join_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of a join contract."""
    both = read(spark, sf_dir, "orders").select("o_custkey").join(read(spark, sf_dir, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return both.agg(F.count("*").alias("rows"), F.count("o_custkey").alias("customers"), F.count("c_custkey").alias("matched"), F.round(F.count("c_custkey").cast("double") / F.count("*"), 4).alias("coverage"))


@report("SELECT c_custkey, sha256(c_custkey || chr(31) || c_name || chr(31) || coalesce(c_mktsegment, chr(0))) AS content_hash FROM customer")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.concat_ws("\x1f", F.col("c_custkey").cast("string"), "c_name", F.coalesce("c_mktsegment", F.lit("\x00")))
    return read(spark, sf_dir, "customer").select("c_custkey", F.sha2(parts, 256).alias("content_hash"))


@report(f"""WITH d AS (SELECT c_custkey, left(sha1(unhex('{NAMESPACE.hex}') || encode('member' || chr(31) || c_custkey || chr(31) || coalesce(c_name, chr(0)))), 32) AS h FROM customer)
SELECT c_custkey, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab', 1 + (position(substr(h, 17, 1) IN '0123456789abcdef') - 1) % 4, 1) || substr(h, 18, 3), substr(h, 21, 12)) AS id FROM d""")
def deterministic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", deterministic_id(F.lit("member"), F.col("c_custkey"), F.col("c_name")).alias("id"))


@report("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT AS links FROM pages""")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)).cast("long")
    return read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), links.alias("links"))


@report("""WITH r AS (SELECT c_custkey % 700 AS source_id, c_name AS display_name, c_acctbal > 0 AS is_current, c_custkey AS seen FROM customer)
SELECT source_id, display_name, is_current FROM r QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY is_current DESC, seen DESC) = 1""")
def member_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per member: the current one wins over former ones, then the latest."""
    rows = read(spark, sf_dir, "customer").select((F.col("c_custkey") % 700).alias("source_id"), F.col("c_name").alias("display_name"), (F.col("c_acctbal") > 0).alias("is_current"), F.col("c_custkey").alias("seen"))
    return register.preferred(rows, ["source_id"], "seen").select("source_id", "display_name", "is_current")


@report("SELECT r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def sql_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    from turnstone.sources.sqltool import read_only

    return read_only(spark, "select r_name, count(*) as nations from region join nation on n_regionkey = r_regionkey group by r_name", {n: f"{sf_dir}/{n}.parquet" for n in ("region", "nation")})


@report("""(SELECT c_nationkey AS k, 'customers only' AS side FROM customer EXCEPT SELECT s_nationkey, 'customers only' FROM supplier WHERE s_acctbal > 5000)
UNION ALL (SELECT c_nationkey, 'both' FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey, 'both' FROM supplier)""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    one = c.select(F.col("c_nationkey").alias("k")).subtract(s.where("s_acctbal > 5000").select("s_nationkey")).withColumn("side", F.lit("customers only"))
    two = c.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(s.select("s_nationkey")).withColumn("side", F.lit("both"))
    return one.unionByName(two)


@report("SELECT event_type, ts::DATE AS day, count(*) AS n FROM events WHERE ts::DATE <> (SELECT max(ts::DATE) FROM events) GROUP BY ALL UNION ALL SELECT event_type, ts::DATE, 2 * count(*) FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events) GROUP BY ALL", dates=("day",))
def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by day, rewrite the last day's partition alone, and read everything back."""
    from turnstone.sources.tables import overwrite_partitions, temporary_path

    path = temporary_path(spark, "roundtrip")
    counts = read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    overwrite_partitions(counts, path, ["day"])
    last = spark.read.parquet(path).agg(F.max("day").alias("day"))
    overwrite_partitions(counts.join(F.broadcast(last), "day").withColumn("n", F.col("n") * 2), path, ["day"])
    return spark.read.parquet(path).select("event_type", "day", "n")
