"""Order-sensitive operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def next_match(df: DataFrame, group: list[str], order: str, matches: Column, fields: list[str], prefix: str) -> DataFrame:
    """Add *fields* of the next row of the group, by *order*, that *matches*.

    A forward as-of lookup in one window.  *order* must be unique per group.
    Rows are read from the last to the first, so the frame only grows and each
    row is visited once.
    """
    ahead = Window.partitionBy(*group).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(matches, F.struct(*fields)), ignorenulls=True).over(ahead)
    out = df.withColumn("_next", found)
    return out.select("*", *(F.col(f"_next.{f}").alias(f"{prefix}{f}") for f in fields)).drop("_next")


def last_known(df: DataFrame, group: list[str], order: str, value: Column, name: str, inclusive: bool = False) -> DataFrame:
    """Add the latest non-null *value* of the rows before (and at) each row."""
    behind = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(behind))


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first *n* rows of each group; the rank limit is pushed below the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def running_clock(df: DataFrame, group: list[str], order: str, clock: str, name: str = "rolled", hours: int = 12, most: int = 2) -> DataFrame:
    """Roll clock readings past midnight: one row per reading, with *name*.

    *clock* is a timestamp without its true day.  A reading, moved by the days
    rolled so far, that lies more than *hours* before the last one rolls one
    day further, *most* times at the most.  Two readings in a row are moved by
    the same days unless the second one rolls, so the raw readings tell where
    that is, and the days rolled are a running count.  Null readings stay null.
    """
    behind = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    at = F.unix_micros(F.col(clock).cast("timestamp"))
    readings = df.select(*group, order, at.alias("_t")).withColumn("_drop", F.last("_t", ignorenulls=True).over(behind) - F.col("_t"))
    rolls = F.count(F.when(F.col("_drop") > hours * 3_600_000_000, 1)).over(upto)
    days = F.least(rolls, F.lit(most)).cast("long")
    rolled = readings.withColumn("days_rolled", days)
    return rolled.select(*group, order, F.timestamp_micros(F.col("_t") + F.col("days_rolled") * 86_400_000_000).alias(name), "days_rolled")
