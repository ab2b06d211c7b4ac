"""Hourly counts as a summing table.

Every batch appends its partial counts as a segment; a read sums the segments by key.  When ``MOST``
segments have gathered, the batch also writes them as one, with a row for each key,
and its manifest lists that one in their stead.  A reader goes by the manifest it began
with, so it sees every count once before, during and after a compaction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("event_hour", "event_name", "privacy_class")
SCHEMA = "event_hour timestamp, event_name string, privacy_class string, event_count long"
MOST = 8


def partial(landed: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "occurred_at").alias("event_hour")
    return landed.groupBy(hour, "event_name", "privacy_class").agg(F.count(F.lit(1)).alias("event_count"))


def summed(spark: SparkSession, segments: list[str]) -> DataFrame:
    if not segments:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*segments).groupBy(*KEY).agg(F.sum("event_count").alias("event_count"))


def appended(segments: list[str], landed: DataFrame, root: str, name: str, between: Callable[[], None] = lambda: None) -> tuple[list[str], list[str]]:
    """The segments with that of ``landed``, and those that they replace."""
    between()
    path = f"{root}/{name}"
    partial(landed).write.mode("overwrite").parquet(path)
    segments = [*segments, path]
    if len(segments) < MOST:
        return segments, []
    between()
    whole = f"{root}/whole-{name}"
    summed(landed.sparkSession, segments).write.mode("overwrite").parquet(whole)
    return [whole], segments
