"""Streams against the batch results, across restarts of their checkpoints."""

import json

import pytest
from frames import rows
from golden import uid
from pyspark.sql import functions as F

from tallybridge.operators import staging
from tallybridge.schemas import COORDINATES, TRANSACTION
from tallybridge.sources.records import RECORD_SCHEMA, file_stream
from tallybridge.streaming.raw_stream import batch_counts, offsets_read, raw_rows, start_raw, start_rejected
from tallybridge.streaming.staging_stream import raw_files, start_quarantine, start_staging


def message(n):
    payload = {
        "operation_id": uid(f"{n:02x}"), "account_number_from": 1, "account_number_to": 2, "currency_code": 430,
        "country": "italy", "status": "done", "transaction_type": "transfer", "amount": n,
        "transaction_dt": "soon" if n == 99 else f"2022-10-0{1 + n % 2} 10:00:00",
    }
    return json.dumps({"object_type": TRANSACTION, "payload": payload})


def put(spark, folder, *coordinates):
    records = [("t", p, o, None, bytearray(message(10 * p + o).encode())) for p, o in coordinates]
    spark.createDataFrame(records, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(query):
    query.awaitTermination()
    return query


def test_repeats_are_dropped_across_restarts(spark, folder):
    put(spark, folder, (0, 0), (0, 1), (0, 2), (0, 2))

    def ingest(*expected):
        records = file_stream(spark, f"{folder}/in")
        query = run(start_raw(records, f"{folder}/raw", f"{folder}/cp", repeats=True, once=True))
        assert batch_counts(query) == list(expected)
        return rows(spark.read.parquet(f"{folder}/raw").select(*COORDINATES))

    assert len(ingest((4, 3))) == 3
    put(spark, folder, (0, 2), (0, 3), (1, 2))
    assert ingest((3, 2)) == [("t", 0, 0), ("t", 0, 1), ("t", 0, 2), ("t", 0, 3), ("t", 1, 2)]
    assert len(ingest()) == 5


def test_stream_equals_batch(spark, folder):
    put(spark, folder, (0, 0), (0, 1), (1, 2))
    put(spark, folder, (9, 9))

    def both():
        records = file_stream(spark, f"{folder}/in", files_per_trigger=1)
        run(start_raw(records, f"{folder}/raw", f"{folder}/cp-raw", once=True))
        stream = raw_files(spark, f"{folder}/raw")
        run(start_staging(stream, TRANSACTION, f"{folder}/stg", f"{folder}/cp-stg", once=True))
        run(start_quarantine(raw_files(spark, f"{folder}/raw"), TRANSACTION, f"{folder}/bad", f"{folder}/cp-bad", once=True))

    both()
    put(spark, folder, (0, 3), (1, 4))
    both()
    stored = spark.read.parquet(f"{folder}/raw")
    parsed = staging.parse_transactions(stored)
    streamed = spark.read.parquet(f"{folder}/stg")
    assert rows(streamed.drop("load_dttm", "p_date")) == rows(staging.staged(parsed, TRANSACTION))
    assert streamed.filter(F.col("p_date") != F.to_date("transaction_dt")).count() == 0
    assert rows(spark.read.parquet(f"{folder}/bad")) == [("t", 9, 9, "transaction_dt")]


def test_failed_batch_is_run_again(spark, folder):
    put(spark, folder, (0, 0), (9, 9))
    query = run(start_raw(file_stream(spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/cp-raw", once=True))
    assert [source["endOffset"] for source in offsets_read(query)] != []
    paths = (f"{folder}/stg", f"{folder}/cp-stg")
    with pytest.raises(Exception, match="cannot stage message"):
        run(start_staging(raw_files(spark, f"{folder}/raw"), TRANSACTION, *paths, mode="fail", once=True))
    run(start_staging(raw_files(spark, f"{folder}/raw"), TRANSACTION, *paths, once=True))
    assert rows(spark.read.parquet(f"{folder}/stg").select("amount")) == [(0,)]


def test_records_without_a_value_are_kept_apart(spark, folder):
    records = [("t", 0, 0, None, bytearray(b"{}")), ("t", 0, 1, None, None)]
    spark.createDataFrame(records, RECORD_SCHEMA).write.parquet(f"{folder}/in")
    run(start_raw(file_stream(spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/cp", once=True))
    run(start_rejected(file_stream(spark, f"{folder}/in"), f"{folder}/bad", f"{folder}/cp-bad", once=True))
    assert rows(spark.read.parquet(f"{folder}/raw").select(*COORDINATES)) == [("t", 0, 0)]
    assert rows(spark.read.parquet(f"{folder}/bad")) == [("t", 0, 1, "no value")]


def test_remembered_keys_are_given_up_after_the_horizon(spark, folder):
    put(spark, folder, (0, 0))
    plan = raw_rows(file_stream(spark, f"{folder}/in"), repeats=True)._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "EventTimeWatermark" in plan
