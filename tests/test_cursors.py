"""Offset windows: every offset is covered once, cursors move forward only."""

import json

import pytest
from frames import rows
from golden import uid
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallybridge.operators import cursors
from tallybridge.plans import ingest
from tallybridge.schemas import CURRENCY, TRANSACTION

MARKS = "kafka_topic string, kafka_partition int, high_watermark bigint"
CURSORS = "kafka_topic string, kafka_partition int, cursor bigint"


def walk(spark, high, batch, start=None):
    """Windows of one stream partition until nothing advances."""
    marks = spark.createDataFrame([("t", 0, high)] if high is not None else [], MARKS)
    cursor, windows = start, []
    while True:
        known = spark.createDataFrame([("t", 0, cursor)] if cursor is not None else [], CURSORS)
        step = cursors.next_windows(marks, known, batch).filter("advanced").first()
        if step is None:
            return windows
        windows.append((step.offset_from, step.offset_to))
        cursor = step.offset_to


def test_windows_count_offsets(spark):
    assert walk(spark, 25, 10) == [(-1, 9), (9, 19), (19, 25)]
    assert walk(spark, None, 10) == []
    assert walk(spark, 25, 10, start=25) == []
    assert walk(spark, 25, 10, start=30) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(high=st.integers(0, 60), batch=st.integers(9, 40))
def test_windows_cover_every_offset_once(spark, high, batch):
    covered = [n for low, top in walk(spark, high, batch) for n in range(low + 1, top + 1)]
    assert covered == list(range(high + 1))


def test_highest_log_entry_counts(spark):
    log = spark.createDataFrame(
        [("a", "t", 0, 5), ("a", "t", 0, 9), ("a", "t", 0, 7), ("b", "t", 0, 1), ("a", "t", 1, 2)],
        "target string, kafka_topic string, kafka_partition int, offset_to bigint",
    )
    assert rows(cursors.current_cursors(log, "a")) == [("t", 0, 9), ("t", 1, 2)]


def message(kind, n):
    if kind == CURRENCY:
        payload = {"date_update": "2022-10-01", "currency_code": n, "currency_code_with": 420, "currency_with_div": 1.5}
    else:
        moment = "soon" if n == 4 else "2022-10-01 10:00:00"
        payload = {
            "operation_id": uid(f"{n:02x}"), "account_number_from": 1, "account_number_to": 2, "currency_code": 430,
            "country": "italy", "status": "done", "transaction_type": "transfer", "amount": n, "transaction_dt": moment,
        }
    return json.dumps({"object_type": kind, "payload": payload})


def test_targets_advance_on_their_own_and_cover_gaps(warehouse, spark):
    kinds = {n: CURRENCY if n % 3 == 0 else TRANSACTION for n in [*range(8), 100]}
    batch = spark.createDataFrame(
        [("t", 0, n, message(kind, n)) for n, kind in kinds.items()],
        "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string",
    )
    ingest.land_batch(warehouse, batch)
    assert ingest.load_staging(warehouse, TRANSACTION, 40) == [("t", 0, -1, 39)]
    assert warehouse.table("stg.currencies").count() == 0
    assert ingest.catch_up(warehouse, 40) == {TRANSACTION: 2, CURRENCY: 3}
    assert rows(warehouse.table("stg.transactions").select("amount")) == [(1,), (100,), (2,), (5,), (7,)]
    assert rows(warehouse.table("stg.currencies").select("currency_code")) == [(0,), (3,), (6,)]
    assert rows(warehouse.table("stg.transactions_rejected").select("kafka_offset", "reject_reason")) == [(4, "transaction_dt")]
    assert ingest.catch_up(warehouse, 40) == {TRANSACTION: 0, CURRENCY: 0}
    stored = warehouse.table("stg.cursors").select("target", "kafka_partition", "offset_to")
    assert rows(stored) == [("stg.currencies", 0, 100), ("stg.transactions", 0, 100)]


def test_targets_may_reject_at_the_same_time(warehouse, spark):
    texts = [message(kind, n).replace("2022-10-01", "soon") for n in range(40) for kind in (TRANSACTION, CURRENCY)]
    batch = spark.createDataFrame(
        [("t", 0, n, text) for n, text in enumerate(texts)],
        "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string",
    )
    ingest.land_batch(warehouse, batch)
    assert ingest.catch_up(warehouse, 30) == {TRANSACTION: 3, CURRENCY: 3}
    assert warehouse.table("stg.transactions_rejected").count() == 40
    assert warehouse.table("stg.currencies_rejected").count() == 40
    assert warehouse.table("stg.transactions").count() == 0


def test_failing_window_leaves_the_cursor(warehouse, spark):
    batch = spark.createDataFrame(
        [("t", 0, 4, message(TRANSACTION, 4))],
        "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string",
    )
    ingest.land_batch(warehouse, batch)
    with pytest.raises(Exception, match="cannot stage message"):
        ingest.load_staging(warehouse, TRANSACTION, 10, mode="fail")
    assert warehouse.table("stg.cursors").count() == 0
    assert warehouse.table("stg.transactions").count() == 0
