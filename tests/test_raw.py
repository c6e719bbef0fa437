"""Dedup on coordinates, batch counts, landing, replay, offset ranges."""

import pytest
from frames import rows

from tallybridge.operators import raw, staging
from tallybridge.plans import ingest
from tallybridge.sources import coordinates
from tallybridge.sources.coordinates import OffsetRange, offset_bucket, scan_ranges, within
from tallybridge.sources.records import KafkaSettings, to_raw

COLUMNS = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string"


def frame(spark, *coordinates_):
    return spark.createDataFrame([(t, p, o, f"{t}{p}{o}") for t, p, o in coordinates_], COLUMNS)


def keys(df):
    return rows(df.select("kafka_topic", "kafka_partition", "kafka_offset"))


STORED = [("t", 0, 0), ("t", 0, 1), ("t", 0, 2)]
BATCH = [("t", 0, 2), ("t", 0, 3), ("t", 0, 3), ("t", 1, 2)]


def test_new_records(spark):
    assert keys(raw.new_records(frame(spark, *BATCH), frame(spark, *STORED))) == [("t", 0, 3), ("t", 1, 2)]


def test_counts(spark):
    counted = raw.batch_counts(frame(spark, *BATCH), frame(spark, *STORED))
    assert rows(counted) == [("t", 0, 3, 1, 0, 2), ("t", 1, 1, 1, 0, 0)]


def test_record_without_value_is_set_aside(spark):
    batch = spark.createDataFrame([("t", 0, 9, None), ("t", 0, 8, "x")], COLUMNS)
    assert keys(raw.new_records(batch, frame(spark, *STORED))) == [("t", 0, 8)]
    assert keys(raw.unreadable(batch)) == [("t", 0, 9)]


def test_landing_and_replay(warehouse, spark):
    first = ingest.land_batch(warehouse, frame(spark, *STORED))
    second = ingest.land_batch(warehouse, frame(spark, *BATCH))
    replay, figures = ingest.replay(warehouse, frame(spark, *STORED, *BATCH))
    empty = ingest.land_batch(warehouse, frame(spark, *STORED).limit(0))
    assert (first.received, first.saved, first.duplicates) == (3, 3, 0)
    assert (second.received, second.saved, second.duplicates) == (4, 2, 2)
    assert (replay.received, replay.saved, replay.duplicates) == (7, 0, 7)
    assert [(f.partition, f.stored, f.earliest, f.latest) for f in figures] == [(0, 3, 0, 3), (1, 2, 2, 2)]
    assert (empty.received, empty.saved) == (0, 0)
    assert keys(warehouse.table("raw.kafka_events")) == sorted({*STORED, *BATCH})


RANGES = [OffsetRange("t", 0, 5, 25), OffsetRange("t", 2, 0, 3), OffsetRange("u", 0, 7, 7)]
INSIDE = sorted([("t", 0, n) for n in range(5, 26)] + [("t", 2, n) for n in range(4)] + [("u", 0, 7)], key=repr)


@pytest.mark.parametrize("sent", [500_000, 0])
def test_both_joins_of_a_range_scan_agree(spark, monkeypatch, sent):
    monkeypatch.setattr(coordinates, "SENT_CELLS", sent)
    stored = frame(spark, *[(t, p, o) for t in "tu" for p in range(3) for o in range(40)])
    ranges = spark.createDataFrame(
        [(r.topic, r.partition, r.first, r.last) for r in RANGES],
        "kafka_topic string, kafka_partition int, first bigint, last bigint",
    )
    assert keys(scan_ranges(stored, ranges)) == INSIDE
    assert keys(scan_ranges(stored, RANGES)) == INSIDE


def test_no_ranges_no_rows(spark):
    assert scan_ranges(frame(spark, *STORED), []).count() == 0


def test_topic_names_are_quoted(spark):
    odd = "it's a \\ topic"
    stored = frame(spark, (odd, 0, 1), ("t", 0, 1))
    assert keys(scan_ranges(stored, [OffsetRange(odd, 0, 0, 5)])) == [(odd, 0, 1)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("count", [3, 600])
def test_range_scan_prunes_buckets_for_any_number_of_ranges(warehouse, spark, count):
    width = coordinates.BUCKET_WIDTH
    ingest.land_batch(warehouse, frame(spark, *[("t", p, b * width + 5) for p in range(3) for b in range(4)]))
    ranges = [OffsetRange("t", p, 2 * width, 2 * width + 9) for p in range(count)]
    scanned = scan_ranges(warehouse.table("raw.kafka_events"), ranges)
    filters = _plan(scanned).split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "concat" not in filters and all(f"{c}#" in filters for c in ("kafka_topic", "kafka_partition", "offset_bucket")), filters
    assert f"GreaterThanOrEqual(kafka_offset,{2 * width})" in _plan(scanned)
    assert keys(scanned) == [("t", p, 2 * width + 5) for p in range(3)]
    read = [f for f in scanned.inputFiles()]
    assert all("offset_bucket=2" in f for f in read) and len(read) == 3


def test_watermarks_come_from_the_log_of_landings(warehouse, spark):
    width = coordinates.BUCKET_WIDTH
    odd = "a topic/with=signs"
    ingest.land_batch(warehouse, frame(spark, *STORED, ("t", 0, 2 * width + 7), ("t", 1, 5), (odd, 0, 3), ("t", 0, width)))
    ingest.land_batch(warehouse, frame(spark, ("t", 1, 2)))
    assert rows(ingest.stored_watermarks(warehouse)) == [(odd, 0, 3), ("t", 0, 2 * width + 7), ("t", 1, 5)]
    assert "kafka_events" not in _plan(ingest.stored_watermarks(warehouse))
    assert keys(scan_ranges(warehouse.table("raw.kafka_events"), [OffsetRange(odd, 0, 0, 9)])) == [(odd, 0, 3)]


def test_what_an_interrupted_landing_left_is_looked_up(warehouse, spark, monkeypatch):
    batch = frame(spark, *STORED)
    with monkeypatch.context() as patch:
        log = ingest._log_loads

        def stop(*args):
            if args[-1] == ingest.LANDED:
                raise RuntimeError("lost between write and commit")
            log(*args)

        patch.setattr(ingest, "_log_loads", stop)
        with pytest.raises(RuntimeError, match="between write and commit"):
            ingest.land_batch(warehouse, batch)
    assert ingest.stored_watermarks(warehouse).count() == 0
    again = ingest.land_batch(warehouse, batch)
    assert (again.received, again.saved, again.duplicates) == (3, 0, 3)
    assert keys(warehouse.table("raw.kafka_events")) == STORED


def test_records_without_a_value_are_kept_apart(warehouse, spark):
    batch = spark.createDataFrame([("t", 0, 7, None), ("t", 0, 7, None), ("t", 0, 8, "x"), ("t", 1, 1, None), ("t", 1, 1, "y")], COLUMNS)
    for expected in ((5, 2, 1, 2), (5, 0, 1, 4)):
        stats = ingest.land_batch(warehouse, batch)
        assert (stats.received, stats.saved, stats.unreadable, stats.duplicates) == expected
    assert keys(warehouse.table("raw.kafka_events")) == [("t", 0, 8), ("t", 1, 1)]
    assert rows(warehouse.table("raw.kafka_rejected").drop("load_dttm")) == [("t", 0, 7, "no value")]
    logged = rows(warehouse.table("raw.batch_stats").select("received", "saved", "duplicates", "unreadable"))
    assert logged == [(5, 0, 4, 1), (5, 2, 2, 1)]


def test_a_batch_without_copies_moves_its_messages_once(spark):
    laid_out = raw.new_records(frame(spark, *BATCH), copies=False).withColumns(
        {"route": raw.route(), "offset_bucket": offset_bucket()}
    )
    plan = _plan(laid_out.hint("rebalance", *ingest.RAW_LAYOUT).sortWithinPartitions(*ingest.RAW_LAYOUT, "kafka_offset"))
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan, plan


@pytest.mark.parametrize(
    "text, route",
    [
        ('{"object_type":"TRANSACTION","payload":{}}', "TRANSACTION"), ("{'object_type': 'CURRENCY'}", "CURRENCY"),
        ('{"object_type":"TRANSACTIO\\u004e"}', "any"), ('{"object_type":"CURRENCY","note":"TRANSACTION"}', "any"),
        ('{"object_type":"AUDIT"}', "none"), ("no json", "none"), ('{"object_type":"TRANSACTION"', "TRANSACTION"),
    ],
)
def test_route_misses_nothing_that_parsing_finds(spark, text, route):
    message = spark.createDataFrame([("t", 0, 0, text)], COLUMNS)
    assert message.select(raw.route().alias("r")).first().r == route
    parsed = staging.parse_envelopes(message, []).first().object_type
    assert parsed in (None, "AUDIT") or route in (parsed, raw.ANY)


def test_a_target_reads_its_own_directories(warehouse, spark):
    texts = ['{"object_type":"TRANSACTION"}', '{"object_type":"CURRENCY"}', "other"]
    ingest.land_batch(warehouse, spark.createDataFrame([("t", 0, n, text) for n, text in enumerate(texts)], COLUMNS))
    own = raw.readable_by(warehouse.table("raw.kafka_events"), "CURRENCY")
    assert keys(scan_ranges(own, [OffsetRange("t", 0, 0, 9)])) == [("t", 0, 1)]
    assert [f.count("route=CURRENCY") for f in scan_ranges(own, [OffsetRange("t", 0, 0, 9)]).inputFiles()] == [1]


def test_rows_beyond_the_fetched_ranges_wait(spark):
    moving = frame(spark, *STORED, ("t", 0, 99), ("u", 0, 1))
    assert keys(within(moving, [OffsetRange("t", 0, 0, 2)])) == STORED


def test_projection_decodes_the_value(spark):
    record = spark.createDataFrame(
        [("t", 3, 7, bytearray("курс".encode()))], "topic string, partition int, offset bigint, value binary"
    )
    assert rows(to_raw(record)) == [("t", 3, 7, "курс")]


def test_kafka_options():
    settings = KafkaSettings("broker", 9091, "events", "loader", "reader", "secret", "/certs/ca.pem")
    options = settings.stream_options()
    assert options["kafka.bootstrap.servers"] == "broker:9091"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "true")
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("5000", "30s")
    replay = settings.replay_options()
    assert (replay["endingOffsets"], replay["maxRecordsPerPartition"]) == ("latest", "1000000")
