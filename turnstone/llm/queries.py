"""The registered corpus queries and, where SQL can express them, their SQL.

A query applies its operator with production parameters to a whole table and
derives the columns to compare from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, license_scan, mixing, near_dedup, pii, quality_model, quality_rules, substring_dedup, token_output, wordarrays
from .common import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Target weights of the mix; names not listed weigh 1.
MIX_WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 3, "src1": 2},
}


def domain_of(source: Column) -> Column:
    """The domain of a source: its number modulo four."""
    return F.concat(F.lit("d"), F.coalesce(F.regexp_extract(source, "[0-9]+", 0).try_cast("int"), F.lit(0)) % 4)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), domain_of(F.col("source")), MIX_WEIGHTS)
    return mixed.select("doc_id", "lang", "source", "mix.domain", "mix.tokens", "mix.copies")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify_quality(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame([*license_scan.TEMPLATES, *license_scan.SHORT_TEMPLATES], "license string, text string")
    return license_scan.license_matches(table(spark, sf_dir, "documents"), templates)


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *(f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def token_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the ids of *docs* with the 49k word vocabulary and read the digest back."""
    import public_tokenizers

    path = f"{Scratch(spark, 'tokens').path}/tokens"
    token_output.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_output.read_tokens(spark, path)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(spark, table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


#: Words of a DuckDB text column, as a list; null gives an empty list.
SQL_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _sql_weights(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items()) + " ELSE 1 END"


def _sql_share(source: str, family: str, name: str) -> str:
    """Deal each family's budget out among its members, fullest first."""
    by = f"PARTITION BY {family} " if family else ""
    return f"""(SELECT *, CASE WHEN filled THEN capacity ELSE (parent_budget - coalesce(sum(capacity) FILTER (WHERE filled) OVER ({by}), 0)) * weight // (sum(weight) FILTER (WHERE NOT filled) OVER ({by})) END AS budget
  FROM (SELECT *, (parent_budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT * weight >= capacity::HUGEINT * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled
    FROM ({source}) WINDOW o AS ({by}ORDER BY capacity::DOUBLE / weight, {name})))"""


OP3_SQL = f"""
WITH sizes AS (
  SELECT doc_id, lang AS lang0, source AS source0, 'd' || (coalesce(try_cast(regexp_extract(source, '[0-9]+') AS INT), 0) % 4) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS id, len({SQL_WORDS.format("text")})::HUGEINT AS tokens FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, (2 * sum(tokens))::HUGEINT AS capacity, {_sql_weights("source")}::HUGEINT AS weight FROM sizes GROUP BY ALL
), languages AS (SELECT domain, lang, sum(capacity)::HUGEINT AS capacity, {_sql_weights("lang")}::HUGEINT AS weight FROM leaves GROUP BY domain, lang),
domains AS (SELECT domain, sum(capacity)::HUGEINT AS capacity, {_sql_weights("domain")}::HUGEINT AS weight FROM leaves GROUP BY domain),
domain_budget AS {_sql_share("SELECT *, (SELECT sum(tokens)::HUGEINT * 600 // 1000 FROM leaves) AS parent_budget FROM domains", "", "domain")},
lang_budget AS {_sql_share("SELECT l.*, d.budget AS parent_budget FROM languages l JOIN domain_budget d USING (domain)", "domain", "lang")},
leaf_budget AS {_sql_share("SELECT l.*, b.budget AS parent_budget FROM leaves l JOIN lang_budget b USING (domain, lang)", "domain, lang", "source")},
ends AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epoch, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaf_budget),
keyed AS (SELECT s.*, epoch, rest, md5('3:' || epoch || ':' || id) AS key FROM sizes s JOIN ends USING (domain, lang, source)),
placed AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE UNBOUNDED PRECEDING), 0)
  - sum(tokens) OVER (PARTITION BY domain, lang, source, key) AS start FROM keyed)
SELECT doc_id, lang0 AS lang, source0 AS source, domain, tokens::BIGINT AS tokens, (epoch + CASE WHEN rest > 0 AND start < rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM placed
"""

#: (doc_id, i, w): every word with its position from 1.  Unnesting keeps long
#: texts linear, which slicing a list inside a lambda would not.
SQL_POSITIONS = f"""words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS w FROM (SELECT doc_id, {{0}} AS w FROM documents)
)"""

OP9_SQL = f"""
WITH RECURSIVE {SQL_POSITIONS.format(SQL_WORDS.format(SQL_LOWER.format("text")))},
sized AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n,
  concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS x FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (SELECT DISTINCT doc_id, x FROM sized WHERE i <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(x) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least USING (doc_id)
"""


def op6_rows(source: str = "documents", tag: str = "") -> str:
    """Common table expressions that judge *source*; the last is ``judged{tag}``."""
    rates = quality_rules.SLACK
    unpivot = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rate, {r} AS v FROM rated{tag} WHERE n_words >= {quality_rules.MIN_WORDS}" for r in rates)
    slack = "CASE rate " + " ".join(f"WHEN '{r}' THEN {v}" for r, v in rates.items()) + " END"
    levels = {"leaf": "lang, source", "lang": "lang", "all": "1"}
    marks, picks, joins = [], [], []
    for level, keys in levels.items():
        by = f"{keys}, rate" if level != "all" else "rate"
        marks.append(f"""counts_{level}{tag} AS (SELECT {by}, bucket, sum(c) AS c FROM leaf{tag} GROUP BY {by}, bucket),
upto_{level}{tag} AS (SELECT *, sum(c) OVER (PARTITION BY {by} ORDER BY bucket) AS upto, sum(c) OVER (PARTITION BY {by}) AS total FROM counts_{level}{tag}),
fence_{level}{tag} AS (SELECT {by}, total, q1 - greatest({quality_rules.REACH} * (q3 - q1), {slack}) AS low, q3 + greatest({quality_rules.REACH} * (q3 - q1), {slack}) AS high
  FROM (SELECT {by}, min(total) AS total, min(bucket) FILTER (WHERE upto * 4 >= total) AS q1, min(bucket) FILTER (WHERE upto * 4 >= total * 3) AS q3 FROM upto_{level}{tag} GROUP BY {by}))""")
    checks = []
    for r in rates:
        for level in levels:
            on = {"leaf": "{0}.lang IS NOT DISTINCT FROM r.lang AND {0}.source IS NOT DISTINCT FROM r.source AND ", "lang": "{0}.lang IS NOT DISTINCT FROM r.lang AND ", "all": ""}[level].format(f"{r}_{level}")
            joins.append(f"LEFT JOIN fence_{level}{tag} AS {r}_{level} ON {on}{r}_{level}.rate = '{r}'")
        def side(x: str, r: str = r) -> str:
            return f"CASE WHEN {r}_leaf.total >= {quality_rules.MIN_ROWS} THEN {r}_leaf.{x} WHEN {r}_lang.total >= {quality_rules.MIN_ROWS} THEN {r}_lang.{x} ELSE {r}_all.{x} END"
        checks.append(f"coalesce(r.{r} <= {side('high')}, true)")
        if r in quality_rules.TWO_SIDED:
            checks.append(f"coalesce(r.{r} >= {side('low')}, true)")
    words = SQL_WORDS.format("text")
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""texts{tag} AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text, {words} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: translate(l, {spaces}, '') <> '') AS lines FROM {source}
), words{tag} AS (SELECT row_id, generate_subscripts(w, 1) AS i, unnest(w) AS w FROM texts{tag}),
windows{tag} AS (SELECT *, count(*) OVER (PARTITION BY row_id) AS n, lag(w) OVER o = w AS stutter,
  concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS x FROM words{tag} WINDOW o AS (PARTITION BY row_id ORDER BY i)),
found{tag} AS (SELECT *, i <= n - 4 AND count(*) FILTER (WHERE i <= n - 4) OVER (PARTITION BY row_id, x) > 1 AS twice FROM windows{tag}),
reached{tag} AS (SELECT *, bool_or(twice) OVER (PARTITION BY row_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM found{tag}),
repeats{tag} AS (SELECT row_id, count(*) FILTER (WHERE inside) AS n_repeat_words, count(*) FILTER (WHERE stutter) AS n_stutters FROM reached{tag} GROUP BY row_id),
counted{tag} AS (SELECT row_id, doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(text, {spaces}, ''))::BIGINT AS word_chars,
  (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_stutters, 0)::BIGINT AS n_stutters,
  (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::BIGINT AS n_capitals, len(lines)::BIGINT AS n_lines
  FROM texts{tag} LEFT JOIN repeats{tag} USING (row_id)
), rated{tag} AS (SELECT *, coalesce(n_symbols * 1000 // nullif(n_words, 0), 0) AS symbol_rate, coalesce(n_capitals * 1000 // nullif(word_chars, 0), 0) AS capital_rate,
  coalesce(n_stutters * 1000 // nullif(n_words, 0), 0) AS stutter_rate, coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0) AS dup_line_rate,
  coalesce(word_chars * 100 // nullif(n_words, 0), 0) AS word_length,
  n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted{tag}
), leaf{tag} AS (SELECT lang, source, rate, CASE WHEN v < 128 THEN v ELSE (v >> (length(bin(v)) - 7)::INT) << (length(bin(v)) - 7)::INT END AS bucket, count(*) AS c
  FROM ({unpivot}) GROUP BY ALL),
{(","+chr(10)).join(marks)},
judged{tag} AS (SELECT r.*, NOT r.base_failed AND {" AND ".join(checks)} AS kept FROM rated{tag} r {" ".join(joins)})"""


OP6_SQL = f"""WITH {op6_rows()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

def _sql_islands(source: str) -> str:
    """Spans of a document that overlap or touch, as one."""
    return f"""(SELECT doc_id, min(word) AS word, max(past) AS past, min(start) AS start, max(stop) AS stop, min(first_doc) AS first_doc
  FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY word, past ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, CASE WHEN word <= max(past) OVER (PARTITION BY doc_id ORDER BY word, past ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins FROM ({source})))
  GROUP BY doc_id, island)"""


_GRAM = substring_dedup.GRAM
_HASH = " + ".join(f"lead(h, {j}) OVER o * {pow(wordarrays.BASE, j, 1 << 64)}::HUGEINT" for j in range(_GRAM))
_BESIDE = """SELECT r.doc_id, r.first_doc, r.shift, r.run, coalesce(min(k) FILTER (WHERE a.w IS NULL OR b.w IS NULL OR a.w <> b.w) - 1, {last}) AS reach
  FROM runs r CROSS JOIN range(1, {gram}) t(k) LEFT JOIN words a ON a.doc_id = r.doc_id AND a.i = {place} LEFT JOIN words b ON b.doc_id = r.first_doc AND b.i = {place} + r.shift GROUP BY ALL"""

OP10_SQL = rf"""
WITH texts AS (SELECT doc_id, {SQL_LOWER.format("text")} AS text FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT doc_id, generate_subscripts(m, 1) AS i, unnest(m) AS m FROM (SELECT doc_id, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS m FROM texts)),
placed AS (SELECT doc_id, i, regexp_replace(m, '^[\x20\x09-\x0D]+', '') AS w, sum(length(m)) OVER p AS stop, sum(length(m) - length(replace(m, chr(10), ''))) OVER p AS line FROM pieces WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
hashes AS (SELECT w, ('0x' || left(md5(w), 8))::UBIGINT::HUGEINT AS h FROM (SELECT DISTINCT w FROM placed)),
words AS (SELECT doc_id, i, w, h, stop - length(w) AS start, stop, line, count(*) OVER (PARTITION BY doc_id) AS n FROM placed JOIN hashes USING (w)),
lines AS (SELECT doc_id, min(i) AS word, max(i) + 1 AS past, min(start) AS start, max(stop) AS stop, string_agg(w, ' ' ORDER BY i) AS x FROM words GROUP BY doc_id, line HAVING count(*) >= {substring_dedup.LINE_WORDS}),
later_lines AS (SELECT doc_id, word, past, start, stop, first_doc FROM (SELECT *, first_value(doc_id) OVER e AS first_doc, row_number() OVER e AS k FROM lines WINDOW e AS (PARTITION BY x ORDER BY doc_id, word)) WHERE k > 1),
grams AS (SELECT doc_id, i, n, ({_HASH}) % 18446744073709551616::HUGEINT AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
least AS (SELECT *, CASE WHEN i <= n - {2 * _GRAM - 2} THEN min(g) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {_GRAM - 1} FOLLOWING) END AS m FROM grams),
chosen AS (SELECT doc_id, i AS word FROM (SELECT *, max(m) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {_GRAM - 1} PRECEDING AND CURRENT ROW) = g AS yes FROM least) WHERE yes),
listed AS (SELECT doc_id, list(w ORDER BY i) AS ws FROM words GROUP BY doc_id),
windows AS (SELECT doc_id, word, array_to_string(ws[word:word + {_GRAM - 1}], ' ') AS x FROM chosen JOIN listed USING (doc_id)),
later AS (SELECT doc_id, word, CASE WHEN back IS NULL THEN first_doc ELSE doc_id END AS first_doc, coalesce(back, first_word) - word AS shift
  FROM (SELECT *, first_value(doc_id) OVER e AS first_doc, first_value(word) OVER e AS first_word, row_number() OVER e AS k, lag(word) OVER (PARTITION BY x, doc_id ORDER BY word) AS back FROM windows WINDOW e AS (PARTITION BY x ORDER BY doc_id, word)) WHERE k > 1),
runs AS (SELECT doc_id, first_doc, shift, run, min(word) AS low, max(word) AS high FROM (
  SELECT *, sum(begins) OVER (PARTITION BY doc_id, first_doc, shift ORDER BY word) AS run FROM (SELECT *, CASE WHEN word - lag(word) OVER (PARTITION BY doc_id, first_doc, shift ORDER BY word) <= {_GRAM} THEN 0 ELSE 1 END AS begins FROM later)
) GROUP BY ALL),
before AS ({_BESIDE.format(last=_GRAM - 1, gram=_GRAM, place="r.low - k")}),
beyond AS ({_BESIDE.format(last=_GRAM - 1, gram=_GRAM, place=f"r.high + {_GRAM - 1} + k")}),
extended AS (SELECT r.doc_id, r.low - p.reach AS word, r.high + {_GRAM} + q.reach AS past, r.first_doc FROM runs r JOIN before p USING (doc_id, first_doc, shift, run) JOIN beyond q USING (doc_id, first_doc, shift, run)),
passages AS (SELECT x.doc_id, x.word, x.past, a.start, b.stop, x.first_doc FROM extended x JOIN words a ON a.doc_id = x.doc_id AND a.i = x.word JOIN words b ON b.doc_id = x.doc_id AND b.i = x.past - 1),
removed AS (SELECT * FROM later_lines UNION ALL SELECT doc_id, word, past, start, stop, first_doc FROM {_sql_islands("SELECT * FROM passages")} WHERE past - word >= {substring_dedup.PASSAGE})
SELECT doc_id, start::BIGINT AS start, stop::BIGINT AS stop, (past - word)::BIGINT AS n_words, past - word >= {substring_dedup.PASSAGE} AS passage, first_doc AS first_doc_id FROM {_sql_islands("SELECT * FROM removed")}
"""

QUERIES: dict[str, Query] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_source_mixing": op3_source_mixing,
    "op4_license_scan": op4_license_scan,
    "op5_html_extraction": op5_html_extraction,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii_spans": op7_pii_spans,
    "op8_token_output": op8_token_output,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op3_source_mixing": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op9_minhash_near_dedup": OP9_SQL,
    "op10_substring_dedup": OP10_SQL,
}
