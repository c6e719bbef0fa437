"""Ranges of stream coordinates as predicates the file scan can prune with.

RAW is laid out by topic, partition and offset bucket. A range per (topic, partition) names the
directories it touches, so a lookup reads these only, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_WIDTH = 10_000_000
# Up to this many touched buckets are sent to every task.
SENT_CELLS = 500_000


@dataclass(frozen=True)
class OffsetRange:
    """Closed range of offsets in one partition of one topic."""

    topic: str
    partition: int
    first: int
    last: int


def offset_bucket(width: int = BUCKET_WIDTH) -> Column:
    return F.expr(f"kafka_offset div {int(width)}")


RANGE = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()), T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
    ]
)


def as_frame(df: DataFrame, ranges: DataFrame | Sequence[OffsetRange]) -> DataFrame:
    if isinstance(ranges, DataFrame):
        return ranges.select(*RANGE.fieldNames())
    return df.sparkSession.createDataFrame([(r.topic, r.partition, r.first, r.last) for r in ranges], RANGE)


def within(df: DataFrame, ranges: DataFrame | Sequence[OffsetRange], width: int = BUCKET_WIDTH) -> DataFrame:
    """Rows whose coordinates lie in the disjoint ``ranges``, of which a bucket holds a few.

    ``intervals.rows_in`` is for many ranges in a bucket: here a row is compared with each of its bucket.
    Ranges are unfolded over the offset buckets they touch and met on topic, partition and
    bucket, so a stream partition that holds most rows is spread over its buckets. As many
    rows as there are touched buckets are sent to every task; beyond SENT_CELLS, some 50 MB,
    both sides are shuffled by the three keys instead.
    """
    given = as_frame(df, ranges)
    if isinstance(ranges, DataFrame):
        touched_buckets = F.sum(F.expr(f"last div {int(width)} - first div {int(width)} + 1"))
        count, lowest, highest = given.agg(touched_buckets, F.min("first"), F.max("last")).first()
    else:
        count = sum(r.last // width - r.first // width + 1 for r in ranges)
        lowest, highest = min((r.first for r in ranges), default=0), max((r.last for r in ranges), default=0)
    if not count:
        return df.filter("false")
    side = given.select(
        F.col("kafka_topic").alias("r_topic"), F.col("kafka_partition").alias("r_partition"),
        F.explode(F.sequence(F.expr(f"first div {int(width)}"), F.expr(f"last div {int(width)}"))).alias("r_bucket"),
        F.col("first").alias("r_first"), F.col("last").alias("r_last"),
    )
    bucket = F.col("offset_bucket") if "offset_bucket" in df.columns else offset_bucket(width)
    met = (
        (F.col("kafka_topic") == F.col("r_topic")) & (F.col("kafka_partition") == F.col("r_partition"))
        & (bucket == F.col("r_bucket")) & F.col("kafka_offset").between(F.col("r_first"), F.col("r_last"))
    )
    near = df.filter(F.expr(f"kafka_offset BETWEEN {int(lowest)} AND {int(highest)}"))
    return near.join(F.broadcast(side) if count <= SENT_CELLS else side, met, "left_semi")


def scan_ranges(raw: DataFrame, ranges: DataFrame | Sequence[OffsetRange], width: int = BUCKET_WIDTH) -> DataFrame:
    """RAW rows whose coordinates lie in ``ranges``, one range per stream partition.

    ``ranges`` is a list or a frame with ``kafka_topic, kafka_partition, first, last``, of which a
    broker has a bounded number. Their directories are named by plain comparisons of the
    partition columns with literals, which a catalog evaluates itself: it hands out the
    directories that a range touches and lists no others.
    """
    if isinstance(ranges, DataFrame):
        ranges = [OffsetRange(*row) for row in ranges.select(*RANGE.fieldNames()).collect()]
    if "offset_bucket" in raw.columns and ranges:
        raw = raw.filter(touched(ranges, width))
    return within(raw, list(ranges), width)


def touched(ranges: Iterable[OffsetRange], width: int = BUCKET_WIDTH) -> Column:
    """The directories of ``ranges``: per topic and buckets, the partitions whose range touches them."""
    alike: dict[tuple[str, int, int], set[int]] = {}
    for r in ranges:
        alike.setdefault((r.topic, r.first // width, r.last // width), set()).add(r.partition)
    named = [
        (F.col("kafka_topic") == topic) & F.col("kafka_partition").isin(*sorted(parts)) & F.col("offset_bucket").between(first, last)
        for (topic, first, last), parts in sorted(alike.items())
    ]
    while len(named) > 1:  # a flat tree, however many there are
        named = [reduce(lambda a, b: a | b, named[n : n + 2]) for n in range(0, len(named), 2)]
    return named[0]
