"""Landings of many ranges: groups are cells or stretches, and no row is compared with many ranges."""

import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallybridge.operators import intervals
from tallybridge.plans import ingest

COLUMNS = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string"
RANGES = "kafka_topic string, kafka_partition int, first bigint, last bigint"


def offsets(spark, where, count=200_000):
    told = spark.range(count).filter(where).withColumnRenamed("id", "kafka_offset")
    return told.select(F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), "kafka_offset", F.lit("m").alias("kafka_message"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain(found):
    return sorted(tuple(r)[2:] for r in found.select(*intervals.PARTITION, "first", "last").collect())


def in_spans(spark, where):
    found = offsets(spark, where)
    return intervals.spans(intervals.cells_of(intervals.blocks(found)), found)


def test_a_row_meets_few_ranges_of_its_cell(spark):
    """Finding 1: a third of all offsets, each a range of its own, and a few longer ranges beside them."""
    where = "id % 3 = 0 AND id < 70000 OR id BETWEEN 150000 AND 150100 OR id = 190000"
    wanted, batch = in_spans(spark, where), offsets(spark, "true")
    size = intervals.size_of(wanted)
    assert (size.offsets, size.dense, size.ranges, size.first, size.last) == (offsets(spark, where).count(), 3, 2, 0, 190_000)
    found = intervals.rows_in(batch, wanted, size)
    assert rows(found.select("kafka_offset")) == rows(offsets(spark, where).select("kafka_offset"))
    per_cell = intervals._by_bits(wanted).groupBy("cell").count().agg(F.max("count")).first()[0]
    assert per_cell == 1


@pytest.mark.parametrize("sent", [50_000_000, 0])
def test_both_joins_of_cells_agree(spark, monkeypatch, sent):
    monkeypatch.setattr(intervals, "SENT", sent)
    wanted = in_spans(spark, "id % 3 = 0 AND id < 40000 OR id > 199990")
    found = intervals.rows_in(offsets(spark, "id % 2 = 0"), wanted, intervals.size_of(wanted))
    assert rows(found.select("kafka_offset")) == rows(offsets(spark, "id % 6 = 0 AND id < 40000 OR id > 199990 AND id % 2 = 0").select("kafka_offset"))
    none = wanted.filter("false")
    assert intervals.rows_in(offsets(spark, "true"), none, intervals.size_of(none)).count() == 0


def test_packed_batches_of_scattered_offsets(warehouse, spark):
    """Finding 1: every sixth offset at a time, then all of them again."""
    for part in range(6):
        assert ingest.land_batch(warehouse, offsets(spark, f"id % 6 = {part}", 30_000)).saved == 5_000
    assert plain(ingest.stored_ranges(warehouse)) == [(0, 29_999)]
    again = ingest.land_batch(warehouse, offsets(spark, "true", 30_000))
    assert (again.saved, again.duplicates) == (0, 30_000)


@pytest.mark.parametrize("seed", range(4))
def test_islands_of_any_ranges(spark, seed):
    """Finding 2: ranges that overlap, touch, cross several stretches or lie in one."""
    draw, width = random.Random(seed), 1 << intervals.STRETCH
    edges = [n * width + d for n in range(5) for d in (-3, -2, -1, 0, 1, 2, 500)]
    given = [(a, max(a, b)) for a, b in ((draw.choice(edges[3:]), draw.choice(edges[3:]) - draw.choice([0, 0, 2 * width])) for _ in range(draw.choice([3, 9, 20])))]
    expected = []
    for a, b in sorted(given):
        if expected and a <= expected[-1][1] + 1:
            expected[-1][1] = max(expected[-1][1], b)
        else:
            expected.append([a, b])
    frame = spark.createDataFrame([("t", 0, a, b) for a, b in given], RANGES)
    assert plain(intervals.islands(frame)) == [tuple(e) for e in expected]
    cut = intervals.in_cells(frame).select("cell", "first", "last").collect()
    assert all(r.first // intervals.CELL == r.last // intervals.CELL == r.cell for r in cut)
    assert sum(r.last - r.first + 1 for r in cut) == sum(b - a + 1 for a, b in expected)


def test_many_ranges_are_sorted_in_stretches_and_cells(spark):
    """Finding 2: no window takes all ranges of a stream partition; one over the stretches alone has a row each."""
    held = spark.createDataFrame([("t", 0, n, n) for n in range(0, 100, 2)], RANGES)
    for line in plan(intervals.judged(in_spans(spark, "id % 2 = 0"), held, held)).splitlines():
        assert "Window [" not in line or "cell#" in line.split("], [")[1], line
    windows = [line for line in plan(intervals.islands(held)).splitlines() if "Window [" in line]
    assert windows and all("stretch#" in w for w in windows)


def test_values_that_come_after_records_without_one(warehouse, spark):
    """Finding 3: a landing looks up and logs what RAW lacks, not the whole batch anew."""
    void = offsets(spark, "true", 40_000).withColumn("kafka_message", F.when(F.col("kafka_offset") % 5 > 0, F.col("kafka_message")))
    for saved in (32_000, 0):
        stats = ingest.land_batch(warehouse, void.unionByName(void.filter("kafka_offset < 70")))
        assert (stats.received, stats.saved, stats.unreadable) == (40_070, saved, 8_000)
    assert warehouse.table("raw.load_runs").count() == 8_000
    assert rows(warehouse.table("raw.kafka_rejected").select("kafka_offset")) == rows(offsets(spark, "id % 5 = 0", 40_000).select("kafka_offset"))
    late = ingest.land_batch(warehouse, offsets(spark, "true", 40_000))
    assert (late.saved, late.duplicates) == (8_000, 32_000)
    assert plain(ingest.stored_ranges(warehouse)) == [(0, 39_999)]


def test_cells_of_far_apart_offsets_hold_no_bitmap(spark):
    """Finding 4: a cell takes as much as its offsets do, and tells the same as a bitmap."""
    batch = offsets(spark, "id % 40000 < 3 OR id BETWEEN 50000 AND 90000").unionByName(offsets(spark, "id % 40000 = 1"))
    found = intervals.cells_of(intervals.blocks(batch))
    assert "bitmap" not in plan(found) and "SortAggregate" not in plan(found)
    columns = [*intervals.PARTITION, "cell", "received", "first", "last", "offsets"]
    assert rows(found.select(*columns)) == rows(intervals.cells(batch).select(*columns))


def test_an_interrupted_landing_is_logged_by_the_next(warehouse, spark, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_log_runs", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            ingest.land_batch(warehouse, offsets(spark, "id % 2 = 0", 100))
    assert ingest.land_batch(warehouse, offsets(spark, "true", 60)).saved == 30
    assert plain(ingest.stored_ranges(warehouse)) == [(0, 59)]
