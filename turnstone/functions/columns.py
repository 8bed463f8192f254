"""Column expressions that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Namespace of all deterministic identifiers.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_DNS, "turnstone")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def count_set(value: Column) -> Column:
    """Distinct non-null values, for columns with few in a group.

    The sets merge like any aggregate, where a distinct count next to others
    would shuffle every row once per count.
    """
    return F.size(F.collect_set(value)).cast("long")


def latest(value: Column, *order: Column) -> Column:
    """The value with the greatest order among rows where it isn't null."""
    key = F.struct(*order) if len(order) > 1 else order[0]
    return F.max_by(value, F.when(value.isNotNull(), key))


def joined_distinct(value: Column, separator: str = ", ") -> Column:
    """Distinct non-null values in order, as one string; null for none."""
    values = F.sort_array(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def joined_ordered(value: Column, order: Column, separator: str) -> Column:
    """Non-null values by *order*, as one string; null for none."""
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.when(F.size(pairs) > 0, F.array_join(F.transform(pairs, lambda p: p["v"].cast("string")), separator))


def squeeze(text: Column) -> Column:
    """Collapse every run of white space, Unicode's included, and trim."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def name_key(text: Column) -> Column:
    """The form under which names are compared."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def word_count(text: Column) -> Column:
    words = squeeze(F.coalesce(text, F.lit("")))
    return F.when(words == "", 0).otherwise(F.size(F.split(words, " ")))


def slug(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9._-]+", "-")


def iso_week(date: Column) -> tuple[Column, Column]:
    """ISO year and week, as longs."""
    return F.extract(F.lit("YEAROFWEEK"), date).cast("long"), F.weekofyear(date).cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two timestamps."""
    minute = lambda t: F.date_trunc("minute", t)
    return F.timestamp_diff("MINUTE", minute(start), minute(end))


def deterministic_id(*parts: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """UUID version 5 of the parts, joined by U+001F; null parts are U+0000."""
    name = F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts))
    digest = F.substring(F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8"))), 1, 32)
    variant = F.lower(F.conv(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8)).cast("string"), 10, 16))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def cosine(x: Column, y: Column) -> Column:
    """Cosine similarity of two float arrays, in doubles; null where a length is zero."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))
