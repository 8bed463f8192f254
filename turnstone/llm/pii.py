"""Personal data by candidate boosting (operator 7).

Base patterns find e-mail addresses, IP addresses, card and telephone numbers
with exact checks.  High-recall generators propose further, overlapping
spans: number groups, long mixed tokens, values assigned to secret names and
spelled-out addresses.  Boosted trees judge each candidate by its format and
context; thresholds of each kind, calibrated on lines of another generator,
select those to add.

The trees are trained on a seeded synthetic sample of TRAIN_ROWS lines, whose
features come from the very expressions that serve in production.  Their sum
is evaluated as a column expression: only DataFrame functions run here.
"""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import evaluated, free_name

#: Kinds, in the order in which spans with the same start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number", "address")
TRAIN_ROWS = 6000
TREES, DEPTH, RATE, CUTS = 30, 3, 0.3, 12
#: Precision that the thresholds are calibrated to on held-out candidates.
PRECISION = 0.98

_OPEN, _CLOSE = "\u0001", "\u0002"

#: The base patterns, written for a matcher that recurses into repeated groups:
#: runs are character classes alone.  ``_PREPARE`` first replaces the characters
#: that end such a run by others.  A leading group saves quadratic scans of long
#: runs: a match starts where its run does, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+\x04-])|\G)[A-Za-z0-9._%+\x04-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9-]",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9][0-9\x20-]*[0-9]",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i)(?:(?<=(?:token|key|secret|password|passwd|pwd|bearer|auth)[\"']{0,1}\x20{0,1}[:=]\x20{0,1}[\"']{0,1})[^\s\"',;]{6,}|(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,})",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9][0-9\x20().\-/]{4,}[0-9](?![0-9A-Za-z])",
    "address": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]+\x20?(?:\x20at\x20|@|\(at\)|\[at\])\x20?[a-z0-9-]+(?:\x20?(?:\x20dot\x20|\(dot\)|\[dot\])\x20?[a-z0-9-]+){1,126}",
}
#: Dots next to a dot may stand in an address's name, not in its host; a card's
#: separators stand alone.  Replacements keep every position.
#: More than two separators in a row end a number.  A host has 127 labels at most.
_PREPARE = {
    "email": (r"\.(?=\.)|(?<=\.)\.", "\u0004"),
    "card": (r"[\x20-](?=[\x20-])|(?<=[\x20-])[\x20-]", "\u0003"),
    "number": (r"[\x20().\-/](?=[\x20().\-/]{2})|(?<=[\x20().\-/])[\x20().\-/](?=[\x20().\-/])|(?<=[\x20().\-/]{2})[\x20().\-/]", "\u0003"),
}
#: Cheap tests that a text must pass before its pattern is tried.
GATES = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
    "secret": lambda t: t.rlike(r"[:=]\x20?[\"']?[^\s\"',;]{6}|[0-9]"),
    "number": lambda t: t.rlike(r"[0-9](?:[\x20().\-/]{0,2}[0-9]){5}"),
    "address": lambda t: t.rlike(r"(?i)@|[\x20(\[]at[\x20)\]]") & t.rlike(r"(?i)[\x20(\[]dot[\x20)\]]"),
}


def _parts(text: Column, kind: str) -> Column:
    """The text split at the pattern's matches: odd elements are matches."""
    ready = F.regexp_replace(text, *_PREPARE[kind]) if kind in _PREPARE else text
    marked = F.regexp_replace(ready, PATTERNS[kind], f"{_OPEN}$0{_CLOSE}")
    return F.when(GATES[kind](text), F.split(marked, f"[{_OPEN}{_CLOSE}]"))


def _let(value: Column, body: "callable") -> Column:
    """*body* of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Elements that are combined anew for each of them, between stored running values.
_BLOCK = 32


def _running(values: Column, combine: "callable", zero: Column) -> Column:
    """The running combination of an array of ints, each with its own element.

    An array that a fold appends to is copied at every step, so only one value
    in _BLOCK is appended.
    """
    block = lambda i: F.floor(i / _BLOCK).cast("int")
    part = lambda v, c, n: F.slice(v, c * _BLOCK + 1, n)

    def of(v: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), block(F.size(v))), lambda c: F.aggregate(part(v, c, F.lit(_BLOCK)), zero, combine))
        before = F.aggregate(sums, F.array(zero), lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x))))
        return _let(before, lambda b: F.transform(v, lambda _, i: F.aggregate(part(v, block(i), i % _BLOCK + 1), F.get(b, block(i)), combine)))

    return _let(values, of)


def _spans(parts: Column, accept: "callable") -> Column:
    """(start, end, value, before, after) of the accepted matches, in code points."""
    hits = F.filter(F.transform(parts, lambda p, i: F.when((i % 2 == 1) & accept(p), i)), lambda i: i.isNotNull())

    def listed(found: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: F.length(p)), lambda a, b: a + b, F.lit(0))

        def span(e: Column, i: Column) -> Column:
            value = F.get(parts, i)
            return F.struct((F.get(e, i) - F.length(value)).alias("start"), F.get(e, i).alias("end"), value.alias("value"), F.right(F.get(parts, i - 1), F.lit(24)).alias("before"), F.left(F.get(parts, i + 1), F.lit(8)).alias("after"))

        return F.when(F.size(found) > 0, _let(ends, lambda e: F.transform(found, lambda i: span(e, i))))

    return _let(hits, listed)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(number)
    digit = lambda i: F.substring(number, n - i + 1, 1).cast("int")
    doubled = lambda i: F.when(i % 2 == 0, digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0)).otherwise(digit(i))
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda a, i: a + doubled(i))
    return (n > 0) & (total % 10 == 0)


def _valid_card(x: Column) -> Column:
    n = F.length(_digits(x))
    return F.when(n.between(12, 19), luhn(_digits(x))).otherwise(F.lit(False))


def _valid_ip(x: Column) -> Column:
    short = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(x, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.substring(short(p), 1, 3).cast("int") <= 255))


ACCEPT = {
    "email": lambda x: F.lit(True),
    "ip": _valid_ip,
    "card": _valid_card,
    "phone": lambda x: F.length(_digits(x)).between(9, 15),
    "secret": lambda x: F.lit(True),
    "number": lambda x: F.length(_digits(x)) >= 6,
    "address": lambda x: F.lit(True),
}


def _features(c: Column, kind: Column) -> list[tuple[str, Column]]:
    """Format and context features of a candidate, all numbers."""
    v, before = c["value"], F.lower(c["before"])
    n = F.length(v)
    count = lambda p: F.length(F.regexp_replace(v, f"[^{p}]", ""))
    flag = lambda x: F.when(x, 1).otherwise(0)
    named = [
        ("kind", kind),
        ("length", n),
        ("digits", count("0-9")),
        ("upper", count("A-Z")),
        ("lower", count("a-z")),
        ("marks", n - count("0-9A-Za-z")),
        ("digit_share", (count("0-9") * 100 / n).cast("int")),
        ("changes", F.length(F.regexp_replace(F.regexp_replace(v, "[0-9]+", "9"), "[A-Za-z]+", "a"))),
        ("letters_run", F.length(F.regexp_replace(v, "^.*?([A-Za-z]*)$", "$1"))),
        ("hex", flag(v.rlike("^[0-9a-fA-F]{24,}$"))),
        ("plus", flag(F.startswith(v, F.lit("+")))),
        ("date", flag(v.rlike(r"^(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}$|^[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}$"))),
        ("grouped", flag(v.rlike(r"^[0-9]{1,3}(?:[., ][0-9]{3})+$"))),
        ("luhn", flag(luhn(F.when(count("0-9").between(12, 19), _digits(v)).otherwise(F.lit(""))))),
        ("assigned", flag(before.rlike(r"[:=]\s?[\"']?$"))),
        ("quoted", flag(before.rlike(r"[\"'`]$"))),
        ("says_secret", flag(before.rlike("token|key|secret|passw|pwd|bearer|auth"))),
        ("says_phone", flag(before.rlike("phone|tel|call|fax|mobile|cell|contact"))),
        ("says_card", flag(before.rlike("card|visa|account|iban|payment"))),
        ("says_id", flag(before.rlike("ssn|social|passport|licen|tax|insurance"))),
        ("says_other", flag(before.rlike("version|isbn|order|page|price|total|commit|sha|md5|build|serial|figure|http|/$"))),
    ]
    return [(name, x.cast("int")) for name, x in named]


FEATURE_NAMES = ("kind", "length", "digits", "upper", "lower", "marks", "digit_share", "changes", "letters_run", "hex", "plus", "date", "grouped", "luhn", "assigned", "quoted", "says_secret", "says_phone", "says_card", "says_id", "says_other")


def _with_spans(docs: DataFrame, text_col: str, kinds: tuple[str, ...], into: str) -> DataFrame:
    """Add the struct *into* with an array of spans for each of *kinds*."""
    clean = free_name(docs, "_clean")
    parts = [free_name(docs, f"_parts_{k}") for k in kinds]
    out = docs.withColumn(clean, F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _OPEN + _CLOSE + "\u0004", "\u0003" * 3))
    out = out.select("*", *(_parts(F.col(clean), k).alias(p) for k, p in zip(kinds, parts, strict=True)))
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    fields = [F.coalesce(_spans(F.col(p), ACCEPT[k]), empty).alias(k) for k, p in zip(kinds, parts, strict=True)]
    return evaluated(out.select(*docs.columns, F.struct(*fields).alias(into)), into)


# --- boosted trees -----------------------------------------------------------------------------


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> tuple | float:
    """A regression tree (feature, cut, below or equal, above) on gradients, or a leaf value."""
    G, H = g[rows].sum(), h[rows].sum()
    best = (1e-6, None, None)
    if depth and len(rows) >= 20:
        for f in range(x.shape[1]):
            col = x[rows, f]
            for cut in np.unique(np.quantile(col, np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")):
                low = col <= cut
                if 5 <= low.sum() <= len(rows) - 5:
                    gl, hl = g[rows][low].sum(), h[rows][low].sum()
                    gain = gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1)
                    if gain > best[0]:
                        best = (gain, f, int(cut))
    if best[1] is None:
        return round(float(-RATE * G / (H + 1)), 6)
    low = x[rows, best[1]] <= best[2]
    return best[1], best[2], _grow(x, g, h, rows[low], depth - 1), _grow(x, g, h, rows[~low], depth - 1)


def _value(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, _value(low, x), _value(high, x))


def boost(x: np.ndarray, y: np.ndarray) -> list[tuple | float]:
    """TREES regression trees fitted to the logistic loss."""
    trees, score = [], np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x, p - y, p * (1 - p), np.arange(len(y)), DEPTH))
        score += _value(trees[-1], x)
    return trees


def calibrate(score: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> float:
    """A threshold above which candidates not trained on reach *precision*.

    It lies midway between the least score taken and the greatest left out, at
    the least score where none is left out; infinite where nothing reaches
    the precision.
    """
    order = np.argsort(-score, kind="stable")
    ranked = score[order]
    hits = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_tie = np.append(ranked[1:] != ranked[:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((hits >= precision) & last_of_tie)
    if not len(good):
        return float("inf")
    upto = good[-1]
    return float(ranked[upto] if upto + 1 == len(ranked) else (ranked[upto] + ranked[upto + 1]) / 2)


def _as_column(tree: tuple | float, features: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    f, cut, low, high = tree
    return F.when(features[FEATURE_NAMES[f]] <= cut, _as_column(low, features)).otherwise(_as_column(high, features))


def training_lines(rows: int = TRAIN_ROWS, seed: int = 7) -> list[tuple[str, int, int]]:
    """(text, start, end) of synthetic lines; the span is personal data, or empty (0, 0)."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("aeioubcdfghlmnprst") for _ in range(r.randint(1, 14)))
    key = lambda a, n: "".join(r.choice(a) for _ in range(n))
    base64, hexes = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef"
    personal = [
        lambda: (r.choice(["token", "api_key", "secret", "auth_token", "access key", "password"]) + r.choice([" = ", "=", ": "]) + (q := r.choice(['"', "'", ""])), key(hexes, r.choice([32, 40, 64])), q),
        lambda: (r.choice(["key: ", "bearer ", "secret = ", "password="]), key(base64, r.randint(12, 48)), ""),
        lambda: (r.choice(["", "with ", "the "]), key(hexes, r.choice([32, 40])), ""),
        lambda: (r.choice(["call ", "phone: ", "tel. ", "", "fax "]), f"({digits(3)}) {digits(3)}-{digits(4)}", ""),
        lambda: (r.choice(["call ", "phone ", "mobile ", ""]), f"{digits(3)}-{digits(3)}-{digits(4)}", ""),
        lambda: (r.choice(["card ", "visa ", "pay with ", ""]), f"{digits(4)} {digits(4)} {digits(4)} {digits(4)}", ""),
        lambda: (r.choice(["card ", "with ", "the "]), r.choice("345689") + digits(15), ""),
        lambda: (r.choice(["ssn ", "social security ", "SSN: "]), f"{digits(3)}-{digits(2)}-{digits(4)}", ""),
        lambda: (r.choice(["mail ", "write to ", ""]), f"{word()} at {word()} dot {r.choice(['com', 'org', 'net'])}", ""),
        lambda: (r.choice(["mail ", "contact ", ""]), f"{word()}[at]{word()}[dot]com", ""),
    ]
    other = [
        lambda: (r.choice(["on ", "since ", ""]), f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", ""),
        lambda: (r.choice(["total ", "about ", "price "]), f"{r.randint(1, 99)},{digits(3)},{digits(3)}", ""),
        lambda: (r.choice(["about ", "with ", "order ", "page "]), digits(r.randint(6, 8)), ""),
        lambda: (r.choice(["isbn ", "ISBN "]), f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", ""),
        lambda: (r.choice(["version ", "build "]), f"{digits(2)}.{digits(2)}.{digits(3)}", ""),
        lambda: (r.choice(["see http://", "path /"]), f"{word()}/{word()}-{word()}-{digits(2)}-{word()}", ""),
        lambda: ("", f"{word()}{word()}-{word()}{word()}-{r.randint(1, 99)}", ""),
        lambda: (r.choice(["commit ", "sha1 ", "md5 "]), key(hexes, r.choice([32, 40])), ""),
        lambda: (r.choice(["from ", "years "]), f"{r.randint(1900, 2020)}-{r.randint(1900, 2030)}", ""),
        lambda: ("the key: ", f"{word()}abcd", " and"),
        lambda: ("", f"{word()} {word()} at {word()} and {word()} polka dot {word()}", ""),
        lambda: ("values ", " ".join(digits(r.randint(1, 2)) for _ in range(r.randint(4, 9))), ""),
    ]
    out = []
    for _ in range(rows):
        good = r.random() < 0.5
        pre, value, post = r.choice(personal if good else other)()
        lead = " ".join(word() for _ in range(r.randint(0, 6)))
        head = f"{lead} {pre}" if lead else pre
        out.append((f"{head}{value}{post} {' '.join(word() for _ in range(r.randint(0, 5)))}", len(head) if good else 0, len(head) + len(value) if good else 0))
    return out


def calibration_lines(rows: int = TRAIN_ROWS // 3, seed: int = 70) -> list[tuple[str, int, int]]:
    """Lines as ``training_lines`` makes, of formats and contexts that those do not have."""
    r = random.Random(seed)
    pick = lambda a, n: "".join(r.choice(a) for _ in range(n))
    digits = lambda n: pick("0123456789", n)
    word = lambda: pick("aeiourstlnmkpd", r.randint(2, 9))
    capitals, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    personal = [
        lambda: (r.choice(["export API_TOKEN=", "Authorization: Bearer: ", "client_secret: ", "--password="]), pick(mixed + "-_", r.randint(20, 300)), ""),
        lambda: ("", r.choice(["ghp_", "sk-", "xoxb-"]) + pick(mixed, 35) + "7a", ""),
        lambda: (r.choice(["ring ", "Tel ", "my mobile is ", "fax: "]), f"{digits(4)} {digits(3)} {digits(3)}", ""),
        lambda: (r.choice(["ring ", "contact ", ""]), f"({digits(3)}){digits(3)}-{digits(4)}", ""),
        lambda: (r.choice(["paid by card ", "account "]), f"{digits(4)}-{digits(4)}-{digits(4)}-{digits(4)}", ""),
        lambda: ("my social security number is ", f"{digits(3)} {digits(2)} {digits(4)}", ""),
        lambda: ("reach me: ", f"{word()}.{word()} (at) {word()} (dot) {r.choice(['de', 'net'])}", ""),
        lambda: ("reach me: ", f"{word()}@{word()} dot {word()} dot com", ""),
    ]
    other = [
        lambda: ("logged ", f"20{digits(2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)} 1{digits(1)}", ""),
        lambda: ("sold ", f"{r.randint(1, 9)}.{digits(3)}.{digits(3)}", ""),
        lambda: ("see ISBN ", f"978 {digits(1)} {digits(3)} {digits(5)} {digits(1)}", ""),
        lambda: ("order no. ", digits(r.randint(6, 9)), ""),
        lambda: ("http://", f"{word()}/{word()}/{digits(4)}/{word()}-{word()}", ""),
        lambda: ("", f"{word()}_{word()}_{word()}_v{r.randint(1, 99)}", ""),
        lambda: ("git commit ", pick("0123456789abcdef", 40), ""),
        lambda: ("the password: ", f"{word()}ing{word()}", ""),
        lambda: ("we meet at ", f"{word()} and each {word()} dot {word()}", ""),
    ]
    out = []
    for _ in range(rows):
        good = r.random() < 0.5
        pre, value, post = r.choice(personal if good else other)()
        lead = " ".join(word() for _ in range(r.randint(1, 5))) + " "
        out.append((f"{lead}{pre}{value}{post} {word()} {pick(capitals, 1)}{word()}", len(lead + pre) if good else 0, len(lead + pre + value) if good else 0))
    return out


_models: dict[int, tuple[list, list[float]]] = {}


def _candidates(spark: SparkSession, lines: list[tuple[str, int, int]]) -> np.ndarray:
    """A row per candidate in *lines*: whether it is personal data, then its features."""
    frame = spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "row int, text string, start int, end int")
    found = _with_spans(frame, "text", KINDS[len(BASE_KINDS) :], "s")
    each = reduce(DataFrame.unionAll, [found.select("row", F.lit(k).alias("k"), "start", "end", F.explode_outer(f"s.{name}").alias("c")) for k, name in enumerate(KINDS[len(BASE_KINDS) :])]).where("c is not null")
    overlap = F.least("end", F.col("c.end")) - F.greatest("start", F.col("c.start"))
    each = each.select("row", (overlap * 2 > F.greatest(F.col("end") - F.col("start"), F.col("c.end") - F.col("c.start"))).cast("int").alias("y"), *(x.alias(n) for n, x in _features(F.col("c"), F.col("k"))))
    return np.array([tuple(r)[1:] for r in each.orderBy("row", "kind", "length").collect()], np.int64)


def trained(spark: SparkSession, seed: int = 7) -> tuple[list[tuple | float], list[float]]:
    """Trees and one threshold a kind, made once in a process.

    The trees learn from TRAIN_ROWS lines; the thresholds are calibrated on
    lines of another generator.
    """
    if seed not in _models:
        table, held = _candidates(spark, training_lines(seed=seed)), _candidates(spark, calibration_lines(seed=10 * seed))
        trees = boost(table[:, 1:], table[:, 0].astype(float))
        score, y, kind = sum(_value(t, held[:, 1:]) for t in trees), held[:, 0].astype(float), held[:, 1]
        _models[seed] = trees, [calibrate(score[kind == k], y[kind == k]) for k in range(len(KINDS) - len(BASE_KINDS))]
    return _models[seed]


def find_pii(docs: DataFrame, text_col: str = "text", *, into: str = "pii") -> DataFrame:
    """*docs*, every row and column, with the array column *into* of spans.

    A span has ``start`` and ``end`` (code points, end exclusive), ``rank`` and
    ``kind``, the kind's place in KINDS and its name; spans are ordered by start, then
    kind.  Base kinds are exact and may overlap one another.  A selected
    candidate is added unless it overlaps a base span; candidates that overlap
    one another are added as one span of the first one's kind.

    Null and empty texts have no spans.  Texts of any length are searched
    whole.  Repeated rows are treated alike, an empty table gives an empty
    one, and a column already called *into* makes the new one ``_into``.
    """
    into = free_name(docs, into)
    trees, thresholds = trained(docs.sparkSession)
    found = _with_spans(docs, text_col, KINDS, into)
    f = lambda k: F.col(f"{into}.{k}")
    ranked = lambda i, k: F.transform(f(k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(i).alias("rank"), F.lit(k).alias("kind")))
    base = F.concat(*(ranked(i, k) for i, k in enumerate(BASE_KINDS)))

    def scored(k: int, kind: str) -> Column:
        def one(s: Column) -> Column:
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(len(BASE_KINDS) + k).alias("rank"), F.lit(kind).alias("kind"), F.struct(*(x.alias(n) for n, x in _features(s, F.lit(k)))).alias("features"))

        return F.transform(f(kind), one)

    extra = F.concat(*(scored(k, kind) for k, kind in enumerate(KINDS[len(BASE_KINDS) :])))
    base_name, extra_name = free_name(docs, "_base"), free_name(docs, "_extra")
    step = found.select(*docs.columns, base.alias(base_name), extra.alias(extra_name))
    total = lambda s: reduce(lambda a, b: a + b, (_as_column(t, s["features"]) for t in trees))

    def selected(s: Column) -> Column:
        limit = F.lit(1e300)
        for k, threshold in enumerate(thresholds):
            limit = F.when(s["rank"] == len(BASE_KINDS) + k, F.lit(min(threshold, 1e300))).otherwise(limit)
        return total(s) >= limit

    def _listed(s: Column, extra: int) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(extra).alias("extra"), (-s["end"]).alias("back"), s["rank"].alias("rank"), s["kind"].alias("kind"))

    listed = F.array_sort(F.concat(F.transform(base_name, lambda s: _listed(s, 0)), F.transform(F.filter(extra_name, selected), lambda s: _listed(s, 1))))
    step = evaluated(step.select(*docs.columns, base_name, listed.alias(extra_name)), extra_name)
    far = F.lit((1 << 31) - 1)
    all_ = F.col(extra_name)
    reach = _running(F.transform(all_, lambda s: F.when(s["extra"] == 0, -s["back"]).otherwise(-1)), lambda a, b: F.greatest(a, b), F.lit(-1))
    ahead = F.reverse(_running(F.reverse(F.transform(all_, lambda s: F.when(s["extra"] == 0, s["start"]).otherwise(far))), lambda a, b: F.least(a, b), far))
    clear = _let(reach, lambda r: _let(ahead, lambda n: F.filter(all_, lambda s, i: (s["extra"] == 1) & (F.get(r, i) <= s["start"]) & (F.get(n, i) >= -s["back"]))))
    none = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")
    has_extra = F.exists(all_, lambda s: s["extra"] == 1)
    step = evaluated(step.select(*docs.columns, base_name, F.when(has_extra, clear).alias(extra_name)), extra_name)

    def joined(ends: Column) -> Column:
        first = F.filter(F.transform(all_, lambda s, i: F.when((i == 0) | (F.get(ends, i - 1) <= s["start"]), i)), lambda i: i.isNotNull())
        one = lambda f, i, t: F.struct(F.get(all_, i)["start"].alias("start"), F.get(ends, F.coalesce(F.get(f, t + 1), F.size(all_)) - 1).alias("end"), F.get(all_, i)["rank"].alias("rank"), F.get(all_, i)["kind"].alias("kind"))
        return _let(first, lambda f: F.transform(f, lambda i, t: one(f, i, t)))

    apart = F.when(F.size(all_) > 0, _let(_running(F.transform(all_, lambda s: -s["back"]), lambda a, b: F.greatest(a, b), F.lit(0)), joined)).otherwise(none)
    by_place = lambda a: F.transform(F.array_sort(F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind")))
    return step.select(*docs.columns, by_place(F.concat(F.col(base_name), apart)).alias(into))


def redact(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """Replace the spans of ``find_pii`` by ``<kind>``; of overlapping spans the first stands."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    piece = lambda a, b: F.substring(text, a + 1, b - a)
    done = F.aggregate(
        F.col(into), start, lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["text"], piece(acc["at"], s["start"]), F.lit("<"), s["kind"], F.lit(">")).alias("text"))).otherwise(acc)
    )
    clean = F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))
    return docs.withColumn(text_col, F.when(F.size(into) > 0, clean).otherwise(F.col(text_col)))


def digest(found: DataFrame, id_col: str = "doc_id", into: str = "pii") -> DataFrame:
    """Counts by kind and of all spans, the hash of the base spans and all spans as text, by document."""
    count = lambda k: F.size(F.filter(into, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter(into, lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(id_col, *(count(k) for k in KINDS), F.size(into).cast("long").alias("n_spans"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(into)).alias("spans"))
