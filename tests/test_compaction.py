"""Packing small files: equal rows, fewer files, and a table that goes on working."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallybridge.plans import compaction, ingest

COLUMNS = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string"
RAW = "raw.kafka_events"


def batch(spark, first, last, topic="t"):
    message = F.concat(F.lit('{"object_type":"TRANSACTION","n":'), F.col("id"), F.lit("}"))
    rows_ = spark.range(first, last).select(F.lit(topic).alias("kafka_topic"), (F.col("id") % 2).cast("int").alias("kafka_partition"), F.col("id").alias("kafka_offset"), message.alias("kafka_message"))
    return rows_


def content(warehouse):
    return rows(warehouse.table(RAW).select("kafka_topic", "kafka_partition", "kafka_offset", "kafka_message", "route"))


def test_batches_end_in_a_file_per_partition(warehouse, spark):
    odd = "it's a topic/with=signs \\ and more"
    for n in range(5):
        ingest.land_batch(warehouse, batch(spark, 100 * n, 100 * n + 100))
        ingest.land_batch(warehouse, batch(spark, 10 * n, 10 * n + 10, odd))
    before = content(warehouse)
    packed = compaction.compact(warehouse, RAW)
    assert (packed.partitions, packed.files_after) == (4, 4) and packed.files_before >= 20
    assert content(warehouse) == before and len(before) == 550
    assert compaction.compact(warehouse, RAW).partitions == 0
    # The table goes on: known records are known, new ones are appended where the partition is now.
    assert ingest.land_batch(warehouse, batch(spark, 0, 600)).saved == 100
    assert len(content(warehouse)) == 650
    assert compaction.compact(warehouse, RAW).files_after == 2


def test_large_files_are_left_alone_and_split_at_the_advisory_size(warehouse, spark):
    for n in range(3):
        ingest.land_batch(warehouse, batch(spark, 4000 * n, 4000 * n + 4000))
    before, size = content(warehouse), compaction.files(warehouse, RAW).agg(F.max("size")).first()[0]
    assert compaction.compact(warehouse, RAW, advisory=size).partitions == 0
    packed = compaction.compact(warehouse, RAW, advisory=100 * size)
    assert packed.files_after == 2 and content(warehouse) == before


def test_a_failed_run_changes_nothing(warehouse, spark, monkeypatch):
    for n in range(3):
        ingest.land_batch(warehouse, batch(spark, 10 * n, 10 * n + 10))
    before = compaction.files(warehouse, RAW).count()
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "point_partitions", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact(warehouse, RAW)
    assert compaction.files(warehouse, RAW).count() == before and len(content(warehouse)) == 30


@pytest.mark.parametrize("text, size", [("64MB", 64 << 20), ("8m", 8 << 20), ("1024", 1024), ("2g", 2 << 30), ("16k", 16384)])
def test_sizes(text, size):
    assert compaction.bytes_of(text) == size
