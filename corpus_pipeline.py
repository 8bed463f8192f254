"""The corpus pipeline: five stages, each written as Parquet and read again.

``run(spark, sf_dir)`` applies STAGES to the table of documents.  A stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.

Every stage takes nulls in any column, empty and very long texts, repeated
rows, an empty table and columns of other names; what it does with them stands
in its docstring and, in full, in that of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.llm import decontaminate, mixing, near_dedup, quality_rules, queries, token_output
from turnstone.llm.common import Scratch


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have no words and go; null languages and sources are
    groups of their own; equal rows are judged alike.
    """
    return quality_rules.quality_rules(docs, into="quality").where("quality.kept").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group of near duplicates.

    Texts without words, and documents without an id, are near nothing and
    stay.  Rows that share an id stay or go together.
    """
    groups = near_dedup.near_duplicates(docs, percent=80)
    dropped = Scratch(spark, "dropped").keep(groups.where("not kept").select("doc_id"), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold nothing and stay, as do documents without an id.
    Rows that share an id stay or go together.
    """
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budget of each domain, language and source takes.

    Null languages and sources count as empty strings.  Documents that share an
    id, or without one their text, tie and are taken together.
    """
    taken = mixing.mix_sources(docs, queries.domain_of(F.col("source")), queries.MIX_WEIGHTS, budget_permille=700, epochs=1)
    return taken.where("mix.copies > 0").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to shards, and the digest of each document read back from them.

    Every row has a digest: null and empty texts the end id alone, documents
    without an id before all others.
    """
    return queries.token_digest(spark, docs)


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicate removal", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("source mixing", mixed),
    ("token ids", token_ids),
]

#: None: slot consistency and the tokenizer have no SQL form; the tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
