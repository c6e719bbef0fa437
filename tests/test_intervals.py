"""Stored offsets as ranges: the set algebra against plain sets, and what landings read."""

import random

import pytest
from frames import rows

from tallybridge.operators import intervals
from tallybridge.plans import ingest
from tallybridge.sources.coordinates import RANGE

COLUMNS = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string"


def batch(spark, *offsets, topic="t", partition=0):
    return spark.createDataFrame([(topic, partition, o, f"m{o}") for o in offsets], COLUMNS)


def spread(found):
    return {o for _, _, first, last in found for o in range(first, last + 1)}


@pytest.mark.parametrize("seed", range(6))
def test_ranges_as_plain_sets(spark, seed):
    """Offsets at the start of one cell and around the end of it."""
    draw = random.Random(seed)
    places = [*range(18), *range(intervals.CELL - 3, intervals.CELL + 4)]
    stored, claimed, arrived = (set(draw.sample(places, draw.choice([0, 3, 9, 15, 22]))) for _ in range(3))
    stored_frame, arrived_frame = batch(spark, *stored), batch(spark, *arrived, *list(arrived)[:3])
    known = intervals.runs(intervals.cells(stored_frame), stored_frame)
    found = sorted(tuple(r) for r in known.select(*intervals.PARTITION, "first", "last").collect())
    assert spread(found) == stored and all(b[2] > a[3] + 1 for a, b in zip(found, found[1:], strict=False))
    claims = spark.createDataFrame([("t", 0, o, o) for o in claimed], RANGE)
    told = intervals.judged(intervals.spans(intervals.cells(arrived_frame), arrived_frame), known, claims)
    seen, looked_up = set(), {r.kafka_offset for r in intervals.offsets_within(told, known).collect()}
    for one in told.collect():
        span = set(range(one.first, one.last + 1))
        expected = "known" if span <= stored else "new" if not span & (stored | claimed) else "mixed"
        assert span <= arrived and one.status == expected and {o // intervals.CELL for o in span} == {one.cell}
        assert span & stored <= looked_up
        seen |= span
    assert seen == arrived and looked_up <= stored
    assert sum(r.received for r in told.collect()) == len(arrived) + len(list(arrived)[:3])
    missing = {o for _, _, a, b, _ in rows(intervals.holes(known)) for o in range(a, b + 1)}
    assert missing == (set(range(min(stored), max(stored))) - stored if stored else set())


def test_stream_partitions_are_kept_apart(spark):
    frame = batch(spark, 1, 2).unionByName(batch(spark, 3, partition=1)).unionByName(batch(spark, 3, topic="u"))
    assert rows(intervals.runs(intervals.cells(frame), frame).select(*intervals.PARTITION, "first", "last")) == [
        ("t", 0, 1, 2), ("t", 1, 3, 3), ("u", 0, 3, 3)
    ]


def test_the_pass_over_a_batch_shuffles_cells_only(spark):
    plan = intervals.cells(batch(spark, 1, 2, 3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "kafka_offset" not in exchange and "kafka_partition" in exchange, exchange


def test_a_replay_reads_neither_raw_nor_its_own_messages(warehouse, spark):
    frame = batch(spark, *range(50))
    ingest.land_batch(warehouse, frame)
    # Gone from RAW, still in the log: what is known is told from the ranges alone.
    for part in warehouse.partitions("raw.kafka_events"):
        spec = ", ".join("{}='{}'".format(*p.split("=")) for p in part.split("/"))
        spark.sql(f"ALTER TABLE {warehouse.name('raw.kafka_events')} DROP PARTITION ({spec})")
    again, _ = ingest.replay(warehouse, frame)
    assert (again.received, again.saved, again.duplicates) == (50, 0, 50)


def test_a_gap_is_filled_without_a_look_at_raw(warehouse, spark, monkeypatch):
    ingest.land_batch(warehouse, batch(spark, *range(10), *range(70_000, 70_010)))
    monkeypatch.setattr(ingest, "scan_ranges", lambda *_: pytest.fail("RAW was read"))
    monkeypatch.setattr(ingest, "_looked_up", lambda *_: pytest.fail("offsets were looked up"))
    filled = ingest.land_batch(warehouse, batch(spark, *range(35_000, 35_020)))
    inside = ingest.land_batch(warehouse, batch(spark, *range(3, 9), 35_003))
    assert (filled.saved, inside.saved, inside.duplicates) == (20, 0, 7)
    assert [r[2:] for r in rows(ingest.stored_ranges(warehouse).select(*intervals.PARTITION, "first", "last"))] == [
        (0, 9), (35_000, 35_019), (70_000, 70_009)
    ]
    assert [tuple(r)[2:] for r in intervals.holes(ingest.stored_ranges(warehouse)).orderBy("first").collect()] == [
        (10, 34_999, 34_990), (35_020, 69_999, 34_980)
    ]


def test_a_landing_that_died_before_its_ranges_is_looked_up(warehouse, spark, monkeypatch):
    frame = batch(spark, *range(20))
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_log_runs", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            ingest.land_batch(warehouse, frame)
    again = ingest.land_batch(warehouse, batch(spark, *range(15, 25)))
    assert (again.saved, again.duplicates) == (5, 5)
    ingest.land_batch(warehouse, frame)
    held = rows(warehouse.table("raw.kafka_events").select("kafka_offset"))
    assert held == sorted([(n,) for n in range(25)], key=repr)


def test_a_raw_that_was_filled_by_other_means_is_recounted(warehouse, spark):
    ingest.land_batch(warehouse, batch(spark, 1, 2, 3, 7))
    before = rows(ingest.stored_ranges(warehouse))
    ingest.recount_ranges(warehouse)
    assert rows(ingest.stored_ranges(warehouse)) == before


def test_records_without_a_value_do_not_count_as_stored(warehouse, spark):
    empty = spark.createDataFrame([("t", 0, 5, None)], COLUMNS)
    assert ingest.land_batch(warehouse, empty).unreadable == 1
    assert ingest.land_batch(warehouse, batch(spark, 5)).saved == 1
    assert ingest.land_batch(warehouse, empty).unreadable == 0
