"""Incremental reading of RAW: cursors, watermarks and offset windows.

A cursor is kept per (target, topic, partition). Of several entries the highest counts, so
a cursor moves forward only and a late or repeated entry cannot move it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGING_BATCH

PARTITION = ["kafka_topic", "kafka_partition"]
NOTHING_READ = -1


def current_cursors(entries: DataFrame, target: str) -> DataFrame:
    return entries.filter(F.col("target") == target).groupBy(*PARTITION).agg(F.max("offset_to").alias("cursor"))


def high_watermarks(raw: DataFrame) -> DataFrame:
    """Highest stored offset per stream partition; no row for a partition without records."""
    return raw.groupBy(*PARTITION).agg(F.max("kafka_offset").alias("high_watermark"))


def top_offset(raw: DataFrame) -> DataFrame:
    """The record furthest along, as a sort with a limit of one."""
    order = [F.desc("kafka_offset"), F.asc("kafka_topic"), F.asc("kafka_partition")]
    return raw.select(*PARTITION, "kafka_offset").orderBy(*order).limit(1)


def next_windows(watermarks: DataFrame, cursors: DataFrame, batch: int = STAGING_BATCH) -> DataFrame:
    """The window ``(offset_from, offset_to]`` each stream partition reads next.

    The width counts offsets, not rows. Where nothing new is stored the cursor stays.
    """
    start = F.coalesce(F.col("cursor"), F.lit(NOTHING_READ).cast("bigint"))
    reach = F.least(F.col("offset_from") + batch, F.col("high_watermark"))
    return (
        watermarks.join(cursors, PARTITION, "left")
        .withColumn("offset_from", start)
        .withColumn("offset_to", F.greatest(reach, F.col("offset_from")))
        .select(
            *PARTITION,
            "high_watermark",
            "offset_from",
            "offset_to",
            (F.col("offset_to") > F.col("offset_from")).alias("advanced"),
        )
    )


def as_ranges(windows: DataFrame) -> DataFrame:
    """Windows with something to read, as closed offset ranges."""
    return windows.filter("advanced").select(
        *PARTITION, (F.col("offset_from") + 1).alias("first"), F.col("offset_to").alias("last")
    )


def advanced_cursors(windows: DataFrame, target: str) -> DataFrame:
    """Entries to add once the windows are loaded."""
    return windows.filter("advanced").select(F.lit(target).alias("target"), *PARTITION, "offset_to")
