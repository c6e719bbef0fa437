"""Messages: complete, incomplete, broken, and timestamps in many spellings."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from golden import uid
from pyspark.sql import functions as F

from tallybridge.functions.timestamps import parse_best_effort
from tallybridge.operators import staging
from tallybridge.schemas import CURRENCY, TRANSACTION, ZERO_UUID

PAYLOAD = {
    "operation_id": uid("a1"),
    "account_number_from": 1001,
    "account_number_to": 2001,
    "currency_code": 430,
    "country": "italy",
    "status": "done",
    "transaction_type": "transfer",
    "amount": -2550,
    "transaction_dt": "2022-10-01 10:00:00.123456",
}
RATE = {"date_update": "2022-10-01T00:00:00Z", "currency_code": 430, "currency_code_with": 420, "currency_with_div": 0.98}


def raw(spark, *messages):
    texts = [m if isinstance(m, str) or m is None else json.dumps(m) for m in messages]
    return spark.createDataFrame(
        [("t", 0, n, text) for n, text in enumerate(texts)],
        "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_message string",
    )


def moved(spark, **changes):
    payload = {**PAYLOAD, **changes}
    payload = {k: v for k, v in payload.items() if v is not KeyError}
    return staging.parse_transactions(raw(spark, {"object_type": TRANSACTION, "payload": payload})).first()


def test_complete_message(spark):
    row = moved(spark)
    assert (row.operation_id, row.account_number_from, row.amount) == (uid("a1"), 1001, -2550)
    assert not row.had_missing and row.reject_reason is None


def test_sub_millisecond_part_is_cut(spark):
    parsed = staging.parse_transactions(raw(spark, {"object_type": TRANSACTION, "payload": PAYLOAD}))
    assert parsed.select(F.date_format("transaction_dt", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] == "2022-10-01 10:00:00.123000"


@pytest.mark.parametrize(
    "changes, field, value, flagged",
    [
        ({"account_number_from": KeyError}, "account_number_from", 0, True),
        ({"account_number_from": None}, "account_number_from", 0, True),
        ({"currency_code": "420"}, "currency_code", 420, False),
        ({"currency_code": 99999999999}, "currency_code", 0, True),
        ({"amount": 5.0}, "amount", 5, True),
        ({"amount": "many"}, "amount", 0, True),
        ({"country": KeyError}, "country", "", True),
        ({"operation_id": uid("a1").upper()}, "operation_id", uid("a1"), False),
        ({"operation_id": KeyError}, "operation_id", ZERO_UUID, True),
        ({"surplus": 1}, "amount", -2550, False),
    ],
)
def test_field_rules(spark, changes, field, value, flagged):
    row = moved(spark, **changes)
    assert (row[field], row.had_missing, row.reject_reason) == (value, flagged, None)


def test_rejects(spark):
    assert moved(spark, operation_id="not-an-id").reject_reason == "operation_id"
    assert moved(spark, transaction_dt="garbage").reject_reason == "transaction_dt"
    assert moved(spark, transaction_dt=KeyError).reject_reason == "transaction_dt"
    empty = staging.parse_transactions(raw(spark, {"object_type": TRANSACTION, "payload": None})).first()
    assert (empty.reject_reason, empty.had_missing, empty.amount) == ("transaction_dt", True, 0)


def test_routing_of_everything(spark):
    whole = json.dumps({"object_type": TRANSACTION, "payload": PAYLOAD})
    messages = raw(
        spark, whole, whole[:-30], whole[:40], {"object_type": CURRENCY, "payload": RATE},
        {"object_type": "OTHER", "payload": {}}, "{}", "no json", "", None,
    )
    counted = {r.route: r.messages for r in staging.route_counts(messages).collect()}
    assert counted == {"transaction": 1, "currency": 1, "none": 7}
    assert staging.parse_transactions(messages).count() == 1
    assert staging.parse_rates(messages).count() == 1


@pytest.mark.parametrize(
    "text, value, flagged",
    [("0.87000001", "0.87000001", False), ("0.123456789012", "0.12345679", True), ("12345678901234", "0", True), ("1e-3", "0.001", False)],
)
def test_rates_are_decimals(spark, text, value, flagged):
    message = json.dumps({"object_type": CURRENCY, "payload": {**RATE, "currency_with_div": "@"}}).replace('"@"', text)
    row = staging.parse_rates(raw(spark, message)).first()
    assert (row.currency_with_div, row.had_missing) == (Decimal(value).quantize(Decimal("1e-8")), flagged)


def test_fail_mode_stops_at_a_poison_message(spark):
    poison = raw(spark, {"object_type": TRANSACTION, "payload": {**PAYLOAD, "transaction_dt": "garbage"}})
    parsed = staging.parse_transactions(poison)
    with pytest.raises(Exception, match="cannot stage message: transaction_dt"):
        staging.staged(parsed, TRANSACTION, mode="fail").collect()
    assert staging.staged(parsed, TRANSACTION).count() == 0
    assert [r.reject_reason for r in staging.rejected(parsed).collect()] == ["transaction_dt"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2022-10-01 00:00:00", "2022-10-01 00:00:00"),
        ("2022-10-01T00:00:00Z", "2022-10-01 00:00:00"),
        ("2022-10-01T03:00:00+03:00", "2022-10-01 00:00:00"),
        ("2022-10-01 12:13:14.123456", "2022-10-01 12:13:14.123"),
        ("2022-10-01", "2022-10-01 00:00:00"),
        ("1664582400", "2022-10-01 00:00:00"),
        ("1664582400123", "2022-10-01 00:00:00.123"),
        ("01/10/2022 00:00:00", "2022-10-01 00:00:00"),
        ("1/10/2022", "2022-10-01 00:00:00"),
        ("01-10-2022 05:06", "2022-10-01 05:06:00"),
        ("2022/10/01 05:06:07", "2022-10-01 05:06:07"),
        ("20221001", "2022-10-01 00:00:00"),
        ("20221001050607", "2022-10-01 05:06:07"),
        ("1 Oct 2022 05:06:07", "2022-10-01 05:06:07"),
        ("Sat, 1 Oct 2022 05:06:07 GMT", "2022-10-01 05:06:07"),
        (" 2022-10-01 ", "2022-10-01 00:00:00"),
        ("12:00:00", None),
        ("garbage", None),
        ("", None),
        (None, None),
        ("2022-13-01", None),
    ],
)
def test_timestamp_spellings(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    found = frame.select(F.date_format(parse_best_effort(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    wanted = expected and datetime.fromisoformat(expected).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    assert found == wanted
