"""Removing files that nothing shows: content stays, kept versions stay readable, new files stay."""

from datetime import UTC, date, datetime, timedelta

import pytest
from frames import rows
from golden import staged
from pyspark.sql import functions as F

from tallybridge.operators import cleaning
from tallybridge.plans import cleanup, compaction, ingest
from tallybridge.plans.partitions import kept_versions, load_shadow, replace_days

D1, D2 = date(2022, 10, 1), date(2022, 10, 2)
TABLE, RAW = "dds.transactions", "raw.kafka_events"
LATER = datetime(9999, 1, 1)


def content(frame):
    return rows(frame.drop("load_dttm"))


def test_dropped_versions_go_and_kept_ones_stay(warehouse, spark):
    clean = cleaning.clean_transactions(staged(spark)[0])
    replace_days(warehouse, TABLE, clean, [D1, D2])
    for _ in range(4):
        replace_days(warehouse, TABLE, clean.filter("status = 'done'"), [D1])
    before = content(warehouse.table(TABLE))
    versions = kept_versions(warehouse, TABLE)
    past = [content(spark.table(v)) for v in versions]
    # The first load's D1 and the second's; lists of two dropped versions.
    removed = cleanup.clean(warehouse, TABLE, LATER)
    assert (removed.folders, len(versions)) == (4, 3) and removed.files >= 4 and removed.bytes > 0
    assert content(warehouse.table(TABLE)) == before
    assert [content(spark.table(v)) for v in versions] == past
    assert cleanup.clean(warehouse, TABLE, LATER) == cleanup.Removed(0, 0, 0)
    replace_days(warehouse, TABLE, clean, [D1, D2])
    assert content(warehouse.table(TABLE)) == content(clean)


def test_a_run_that_failed_goes_once_it_is_old(warehouse, spark):
    clean = cleaning.clean_transactions(staged(spark)[0])
    replace_days(warehouse, TABLE, clean, [D1, D2])
    load_shadow(warehouse, TABLE, clean, [D1, D2])  # and never switched to
    hour_ago = datetime.now(UTC) - timedelta(hours=1)
    assert cleanup.clean(warehouse, TABLE, hour_ago).folders == 0
    assert cleanup.clean(warehouse, TABLE, LATER, at_once=1).folders == 1
    assert cleanup.clean(warehouse, TABLE, LATER).folders == 1
    assert content(warehouse.table(TABLE)) == content(clean)


def test_packed_partitions_leave_nothing_behind(warehouse, spark):
    odd = "it's a topic/with=signs \\ 100% and more"
    for n in range(6):
        topic = F.when(F.col("id") % 3 == 0, odd).otherwise("t").alias("kafka_topic")
        message = F.concat(F.lit('{"object_type":"TRANSACTION","n":'), F.col("id"), F.lit("}")).alias("kafka_message")
        batch = spark.range(10 * n, 10 * n + 10).select(topic, F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"), message)
        ingest.land_batch(warehouse, batch)
    before = content(warehouse.table(RAW))
    assert cleanup.clean(warehouse, RAW, LATER).folders == 0
    packed = compaction.compact(warehouse, RAW)
    removed = cleanup.clean(warehouse, RAW, LATER)
    assert (removed.folders, removed.files) == (packed.partitions, packed.files_before) == (2, 12)
    assert content(warehouse.table(RAW)) == before
    ingest.land_batch(warehouse, batch)
    assert content(warehouse.table(RAW)) == before
    assert cleanup.clean(warehouse, RAW, LATER).folders == 0


def test_nothing_stored_and_no_partitions(warehouse):
    assert cleanup.clean(warehouse, TABLE, LATER) == cleanup.Removed(0, 0, 0)
    assert cleanup.clean(warehouse, RAW, LATER) == cleanup.Removed(0, 0, 0)
    with pytest.raises(ValueError, match="no partitions"):
        cleanup.clean(warehouse, "dds.dim_currency", LATER)
