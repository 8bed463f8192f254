"""Raw days as a stream: each micro-batch's days are parsed and replace their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnstone.sources.transcripts import normalize, raw_files, write_tables

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def ingest(spark: SparkSession, raw_root: str, table_root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Watch *raw_root* for files and rewrite the days they belong to.

    A batch names the days that changed; each such day is read whole again, so
    a file that arrives late lands beside the day's earlier ones.  Rewriting a
    partition is idempotent, so a repeated batch changes nothing.
    """
    place = r"([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})/([^/]+)/([^/]+)$"
    stream = spark.readStream.format("binaryFile").schema(_BINARY).load(f"{raw_root}/*/*/*/*")
    days = stream.select(*(F.regexp_extract("path", place, i).alias(n) for i, n in enumerate(("jurisdiction", "date", "house_code"), 1)))

    def replace(batch: DataFrame, _: int) -> None:
        changed = batch.where("date <> ''").distinct()
        files = raw_files(batch.sparkSession, raw_root).join(changed, ["jurisdiction", "date", "house_code"], "left_semi")
        write_tables(normalize(files), table_root)

    return days.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
