"""Quality rules with thresholds that follow each language and source (operator 6).

Base rules look at a text alone.  Adaptive rules compare a text's rates with
fences from the quantiles of its (language, source) group.  Quantiles come
from mergeable log-linear sketches: integer bucket counts, exact to merge in
any order, with buckets no wider than 1/64 of their value.  A group with fewer than
``min_rows`` texts uses the merged sketch of its language, and a language with
fewer the sketch of all.

Only DataFrame functions run here; texts never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, evaluated, free_name, split_words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Rates judged against fences, with the least distance of a fence from its
#: quartile, so that groups of near-constant texts don't reject small noise:
#: symbols, capitals, repeated neighbours and repeated lines in thousandths of
#: words, word characters, words and lines; hundredths of a character a word.
SLACK = {"symbol_rate": 100, "capital_rate": 200, "stutter_rate": 100, "dup_line_rate": 500, "word_length": 200}
#: Rates with a lower fence too.
TWO_SIDED = ("word_length",)
REACH = 3
MIN_ROWS = 100


def measured(docs: DataFrame, text_col: str, into: str, repeats: bool = True) -> DataFrame:
    """*docs* with the struct column *into*: counts, rates and the base verdict.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` are longs,
    zero for null and empty texts.  Without *repeats*, the rates alone:
    ``n_repeat_words`` and ``base_failed``, which no fence needs, are left out.

    Windows are sorted by hash, those equal to a neighbour are sorted by
    position, and each covers what the next one leaves: n log n for any text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, lines, hashes, starts = (free_name(docs, n) for n in ("_words", "_lines", "_hashes", "_starts"))
    own = docs.columns
    step = docs.select("*", split_words(text).alias(w), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(lines))
    n = F.size(w)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    counts = [
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(w, lambda x, i: (x == F.get(F.col(w), i - 1)) & (i > 0))).cast("long").alias("n_stutters"),
        count("[A-Z]").alias("n_capitals"),
        F.size(lines).cast("long").alias("n_lines"),
    ]
    if repeats:
        window_hash = lambda x, i: F.xxhash64(x, *(F.get(F.col(w), i + j) for j in range(1, WINDOW)))
        step = step.withColumn(hashes, F.when(n >= WINDOW, F.transform(F.slice(w, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))), window_hash)))
        repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        step = step.withColumn(hashes, F.when(repeated, ordered))
        at = lambda i: F.get(F.col(hashes), i)["h"]
        twin = lambda x, i: F.coalesce(F.when(i > 0, at(i - 1) == x["h"]), F.lit(False)) | F.coalesce(at(i + 1) == x["h"], F.lit(False))
        step = step.withColumn(starts, F.array_sort(F.transform(F.filter(hashes, twin), lambda x: x["i"])))
        covered = F.aggregate(F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(starts), i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
        counts.append(F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    step = step.select(*own, F.struct(*counts).alias(into))
    m = lambda name: F.col(f"{into}.{name}")
    rate = lambda part, whole, unit: F.when(m(whole) > 0, F.expr(f"({into}.{part} * {unit}) div {into}.{whole}")).otherwise(F.lit(0).cast("long"))
    rates = [
        rate("n_symbols", "n_words", 1000).alias("symbol_rate"),
        rate("n_capitals", "word_chars", 1000).alias("capital_rate"),
        rate("n_stutters", "n_words", 1000).alias("stutter_rate"),
        rate("n_dup_lines", "n_lines", 1000).alias("dup_line_rate"),
        rate("word_chars", "n_words", 100).alias("word_length"),
    ]
    if repeats:
        failed = (m("n_words") < MIN_WORDS) | (m("n_repeat_words") * 100 > m("n_words") * MAX_REPEAT_PERCENT)
        rates.append(failed.alias("base_failed"))
    return evaluated(step.select(*own, F.struct(f"{into}.*", *rates).alias(into)), into)


def bucket(value: Column) -> Column:
    """Lower end of a value's sketch bucket: exact below 128, then 64 buckets a doubling."""
    shift = F.length(F.bin(value)) - 7
    return F.when(value < 128, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift))


def fences(rated: DataFrame, lang: str, source: str, scratch: Scratch, min_rows: int = MIN_ROWS, reach: int = REACH) -> DataFrame:
    """One row per (lang, source) with ``<rate>_low`` and ``<rate>_high``.

    *rated* has the two key columns, ``n_words`` and the rates; texts of fewer
    than MIN_WORDS words don't count.  Counts are combined before the shuffle
    and there is one row per bucket after it.
    """
    parts = F.array(*(F.struct(F.lit(name).alias("rate"), bucket(F.col(name)).alias("bucket")) for name in SLACK))
    exploded = rated.where(F.col("n_words") >= MIN_WORDS).select(lang, source, F.explode(parts).alias("p"))
    leaf = scratch.keep(exploded.groupBy(lang, source, F.col("p.rate").alias("rate"), F.col("p.bucket").alias("bucket")).agg(F.count("*").alias("rows")), "sketches")
    levels = {"leaf": [lang, source], "lang": [lang], "all": []}
    out = leaf.select(lang, source).distinct()
    for level, keys in levels.items():
        counts = leaf.groupBy(*keys, "rate", "bucket").agg(F.sum("rows").alias("rows"))
        span = Window.partitionBy(*keys, "rate")
        counts = counts.withColumn("upto", F.sum("rows").over(span.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("rows").over(span))
        marks = counts.groupBy(*keys, "rate").agg(
            F.min("total").alias("total"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
        )
        columns = [F.min("total").alias(f"total_{level}")]
        for name, slack in SLACK.items():
            spread = F.greatest((F.col("q3") - F.col("q1")) * reach, F.lit(slack))
            columns.append(F.max(F.when(F.col("rate") == name, F.struct((F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")))).alias(f"{name}_{level}"))
        wide = marks.groupBy(*keys).agg(*columns)
        if keys:
            wide = wide.select(*(F.col(k).alias(f"{level}_{k}") for k in keys), *(c for c in wide.columns if c not in keys))
            out = out.join(wide, [out[k] == wide[f"{level}_{k}"] for k in keys], "left").drop(*(f"{level}_{k}" for k in keys))
        else:
            out = out.join(F.broadcast(wide), F.lit(True), "left")
    picked = []
    for name in SLACK:
        best = F.when(F.col("total_leaf") >= min_rows, F.col(f"{name}_leaf")).when(F.col("total_lang") >= min_rows, F.col(f"{name}_lang")).otherwise(F.col(f"{name}_all"))
        picked += [best["low"].alias(f"{name}_low"), best["high"].alias(f"{name}_high")]
    return out.select(lang, source, *picked)


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    *,
    min_rows: int = MIN_ROWS,
    reach: int = REACH,
    into: str = "quality",
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """*docs*, every row and column, with the struct column *into*.

    Its fields are the counts and rates of ``measured``, ``base_failed`` and
    ``kept``: not base_failed, and every rate within its group's fences.

    Null and empty texts have zero words and fail.  Null languages and sources
    form groups of their own, apart from empty strings.  Ties on a fence are
    kept.  Repeated rows are judged alike.  An empty table gives an empty one.
    A column already called *into* makes the new one ``_into``.

    Texts are read twice, once for the sketches' rates and once for the verdict,
    so that they are never shuffled or stored.  The fence table has a row per
    group; it is broadcast up to *broadcast_rows* groups and joined by a
    splittable shuffle beyond.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    into = free_name(docs, into)
    key = lambda c: F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(c).cast("string")))
    narrow = docs.select(key(lang_col).alias("lang_key"), key(source_col).alias("source_key"), F.col(text_col).alias("text"))
    rated = measured(narrow, "text", "m", repeats=False).select("lang_key", "source_key", "m.*")
    limits = scratch.keep(fences(rated, "lang_key", "source_key", scratch, min_rows, reach), "fences")
    rows = measured(docs, text_col, into)
    few = limits.count() <= broadcast_rows

    lk, sk, fence = (free_name(docs, n) for n in ("_lang_key", "_source_key", "_fence"))
    named = limits.select(F.col("lang_key").alias(lk), F.col("source_key").alias(sk), F.struct(*(c for c in limits.columns if not c.endswith("_key"))).alias(fence))
    joined = rows.withColumns({lk: key(lang_col), sk: key(source_col)}).join(F.broadcast(named) if few else named, [lk, sk], "left")
    inside = ~F.col(f"{into}.base_failed")
    for name in SLACK:
        inside &= F.coalesce(F.col(f"{into}.{name}") <= F.col(f"{fence}.{name}_high"), F.lit(True))
        if name in TWO_SIDED:
            inside &= F.coalesce(F.col(f"{into}.{name}") >= F.col(f"{fence}.{name}_low"), F.lit(True))
    return joined.select(*docs.columns, F.struct(f"{into}.*", inside.alias("kept")).alias(into))
