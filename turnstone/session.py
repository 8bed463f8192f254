"""Session construction with the settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps timestamps comparable between engines; dynamic overwrite makes a
#: partitioned rewrite replace only the partitions it touches.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "turnstone", **conf: object) -> SparkSession:
    """Return a session with SETTINGS, then *conf* (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
