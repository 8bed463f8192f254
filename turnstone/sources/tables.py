"""Table sources and sinks: typed scans, partition overwrites, consolidation, guards."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def temporary_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder; a local one only on a single machine where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    path = f"{(root or tempfile.mkdtemp(prefix='turnstone-')).rstrip('/')}/turnstone-{name}-{uuid.uuid4().hex}"
    _temporary.append((spark, path))
    return path


_temporary: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean_up() -> None:
    for spark, path in _temporary:
        with contextlib.suppress(Exception):  # the session may be gone already
            delete(spark, path)


def scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at *path* with *schema*, or an empty one of that schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def register(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> None:
    """A view for each table under *root*, present or not."""
    for name, schema in schemas.items():
        scan(spark, f"{root}/{name}", schema).createOrReplaceTempView(name)


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str], compression: str = "zstd") -> None:
    """Replace exactly the partitions that *df* has rows for; an empty frame writes nothing.

    Rows are dealt by partition value; adaptive execution joins small values
    into one writer and gives a large one several.
    """
    df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression).partitionBy(*partitions).parquet(path)


def partition_values(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Distinct partition values; only partition columns are read."""
    return spark.read.parquet(path).select(*columns).distinct()


def consolidate(df: DataFrame, path: str, date_col: str = "date", keys: tuple[str, ...] = ("model_slug", "jurisdiction"), rows_per_file: int = 50_000) -> None:
    """Rewrite by model, jurisdiction and year in large files; a large year has several writers."""
    out = df.withColumn("year", F.year(date_col))
    out.hint("rebalance", *keys, "year").write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*keys, "year").parquet(path)


def join_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), *(F.count(c).alias(c) for c in columns))


def require_coverage(df: DataFrame, column: str, least: float = 0.95, force: bool = False) -> float:
    """The share of rows whose *column* isn't null; an error below *least* unless forced."""
    row = join_coverage(df, [column]).first()
    share = row[column] / row["rows"] if row["rows"] else 1.0
    if share < least and not force:
        raise ValueError(f"{column} is set in {share:.1%} of rows, under {least:.0%}")
    return share


def raw_days(spark: SparkSession, root: str) -> DataFrame:
    """(jurisdiction, date, house_code, documents, harvested_at) from meta.json files.

    Folders whose date isn't one are skipped and unreadable files give nulls.
    """
    files = spark.read.format("binaryFile").load(f"{root}/*/*/*/meta.json")
    place = r"([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/([^/]+)/meta\.json$"
    part = lambda i: F.regexp_extract("path", place, i)
    meta = F.from_json(F.decode("content", "UTF-8"), "documents bigint, harvested_at string", {"mode": "PERMISSIVE"})
    rows = files.select(part(1).alias("jurisdiction"), part(2).try_cast("date").alias("date"), part(3).alias("house_code"), meta.alias("m"))
    return rows.where("date is not null").select("jurisdiction", "date", "house_code", "m.documents", "m.harvested_at")
