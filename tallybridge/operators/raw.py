"""RAW layer: each stream record is stored once, identified by its coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COORDINATES, CURRENCY, TRANSACTION

ANY = "any"
PARTITION = COORDINATES[:2]


def readable(batch: DataFrame) -> DataFrame:
    """Records with a value; a record without one cannot be decoded."""
    return batch.filter(F.col("kafka_message").isNotNull())


def unreadable(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("kafka_message").isNull())


def route() -> Column:
    """Which target can find rows in a message: a type, ``any`` or ``none``.

    RAW is laid out by it, so a target reads and parses its own messages only. It is told
    from the text without parsing: a message of a type must spell its name or hold an
    escape. So nothing that parsing would route is missed, and what is doubtful is ``any``.
    """
    message = F.col("kafka_message")
    moved, quoted = F.contains(message, F.lit(TRANSACTION)), F.contains(message, F.lit(CURRENCY))
    doubtful = F.contains(message, F.lit("\\")) | (moved & quoted)
    return F.when(doubtful, ANY).when(moved, TRANSACTION).when(quoted, CURRENCY).otherwise("none")


def readable_by(raw: DataFrame, object_type: str) -> DataFrame:
    """The rows of RAW that may be of a type; a filter on a partition column."""
    return raw.filter(F.col("route").isin(object_type, ANY))


def one_per_coordinate(batch: DataFrame) -> DataFrame:
    """Copies inside the batch collapse before the shuffle.

    An aggregate combines copies on the map side, so a record repeated a billion times
    leaves each task as one row. ``min`` makes the surviving text independent of order and
    passes over copies without a value.
    """
    return batch.groupBy(*COORDINATES).agg(F.min("kafka_message").alias("kafka_message"))


def touched_ranges(batch: DataFrame) -> DataFrame:
    """Per stream partition the lowest and highest offset and the number of records."""
    return batch.groupBy(*PARTITION).agg(
        F.min("kafka_offset").alias("first"), F.max("kafka_offset").alias("last"), F.count(F.lit(1)).alias("received")
    )


def new_records(batch: DataFrame, stored: DataFrame | None = None, copies: bool = True) -> DataFrame:
    """Records of ``batch`` with a value that are not in ``stored``, each once.

    Nothing is looked up without ``stored``, and a batch without ``copies`` needs no
    aggregate over its messages. The lookup spreads both sides by the full coordinates,
    which are unique by then, so a stream partition that holds most rows is no hot key.
    """
    single = one_per_coordinate(readable(batch)) if copies else readable(batch)
    return single if stored is None else single.join(stored.select(*COORDINATES), COORDINATES, "left_anti")


def new_unreadable(batch: DataFrame, *stored: DataFrame) -> DataFrame:
    """Coordinates of records without a value that none of ``stored`` holds, each once."""
    found = unreadable(batch).select(*COORDINATES).distinct()
    for held in stored:
        found = found.join(held.select(*COORDINATES), COORDINATES, "left_anti")
    return found


def batch_counts(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """What becomes of the records of a batch, per stream partition.

    Received are all records. Saved are coordinates that RAW gains, unreadable those without
    a value in any copy that it does not hold; every other record is a duplicate.
    """
    received = batch.groupBy(*COORDINATES).agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(F.col("kafka_message").isNotNull()).alias("values")
    )
    known = stored.select(*COORDINATES, F.lit(True).alias("is_stored"))
    new = F.col("is_stored").isNull()
    return (
        received.join(known, COORDINATES, "left")
        .groupBy(*PARTITION)
        .agg(
            F.sum("copies").alias("received"),
            F.count_if(new & (F.col("values") > 0)).alias("saved"),
            F.count_if(new & (F.col("values") == 0)).alias("unreadable"),
        )
        .withColumn("duplicates", F.col("received") - F.col("saved") - F.col("unreadable"))
    )
