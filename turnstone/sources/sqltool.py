"""Ad-hoc read-only SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

MOST_ROWS = 1000
_ALLOWED = re.compile(r"\s*(select|with|describe|show|summarize|explain)\b", re.I)


def check_statement(statement: str) -> str:
    """The statement without its last semicolon; an error unless it is one read."""
    body = statement.strip().rstrip(";").strip()
    if not _ALLOWED.match(body):
        raise ValueError("only SELECT, WITH, DESCRIBE, SHOW, SUMMARIZE and EXPLAIN are allowed")
    if ";" in re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"", "", body):
        raise ValueError("one statement at a time")
    if re.match(r"\s*with\b", body, re.I) and re.search(r"\b(insert|merge|update|delete)\s+(into|from)\b", body, re.I):
        raise ValueError("the statement writes")
    return body


def read_only(spark: SparkSession, statement: str, tables: Mapping[str, str] | None = None, limit: int = MOST_ROWS) -> DataFrame:
    """The statement's first *limit* rows; *tables* maps view names to Parquet paths."""
    body = check_statement(statement)
    for name, path in (tables or {}).items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    if m := re.match(r"summarize\s+(.*)", body, re.I | re.S):
        return spark.table(m[1].strip()).summary()
    return spark.sql(body).limit(limit)
