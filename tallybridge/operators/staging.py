"""STG layer: typed rows from message text.

The message is parsed once per row. ``inline`` over a one-element array keeps the
parsed struct behind a generator: as a plain projection, the routing filter would be
pushed below it and parse every message a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import decimal_number, is_uuid, plain_text, uuid_text, whole_number
from ..functions.timestamps import parse_best_effort
from ..schemas import COORDINATES, CURRENCY, STG_CURRENCIES, TRANSACTION, TRANSACTIONS, envelope, flagged

TARGETS = {TRANSACTION: TRANSACTIONS, CURRENCY: STG_CURRENCIES}


def parse_envelopes(raw: DataFrame, payload_fields: list[str]) -> DataFrame:
    """Coordinates, ``object_type`` and ``payload`` with text leaves; no type where the text is no JSON."""
    event = F.from_json("kafka_message", envelope(payload_fields), {"columnNameOfCorruptRecord": "broken"})
    whole = F.when(F.col("broken").isNull(), F.col("object_type"))
    return raw.select(*COORDINATES, F.inline(F.array(event))).select(
        *COORDINATES, whole.alias("object_type"), "payload"
    )


def _read(field: str, kind: str) -> tuple[Column, Column]:
    text = F.col(f"payload.{field}")
    if field == "operation_id":
        return uuid_text(text)
    if kind in ("bigint", "int"):
        return whole_number(text, kind)
    if kind == "timestamp":
        moment = parse_best_effort(text)
        return moment, moment.isNotNull()
    if kind.startswith("decimal"):
        return decimal_number(text, 18, 8)
    return plain_text(text)


def _parse(raw: DataFrame, object_type: str) -> DataFrame:
    target = TARGETS[object_type]
    routed = parse_envelopes(raw, target.fieldNames()).filter(F.col("object_type") == object_type)
    values, exact = [], F.lit(True)
    for field in target.fields:
        value, unaltered = _read(field.name, field.dataType.simpleString())
        values.append(value.alias(field.name))
        exact = exact & unaltered
    return routed.select(*COORDINATES, *values, (~exact).alias("had_missing"))


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions with ``had_missing`` and, for rows that cannot be staged, ``reject_reason``."""
    reason = F.when(F.col("transaction_dt").isNull(), "transaction_dt").when(
        ~is_uuid(F.col("operation_id")), "operation_id"
    )
    return _parse(raw, TRANSACTION).withColumn("reject_reason", reason)


def parse_rates(raw: DataFrame) -> DataFrame:
    return _parse(raw, CURRENCY).withColumn("reject_reason", F.when(F.col("date_update").isNull(), "date_update"))


PARSERS = {TRANSACTION: parse_transactions, CURRENCY: parse_rates}


def staged(parsed: DataFrame, object_type: str, mode: str = "quarantine") -> DataFrame:
    """Rows for the staging table, with the flag of those that had a field defaulted or altered.

    ``quarantine`` leaves rejected rows to ``rejected``; ``fail`` ends the job at the
    first one, so the window is not committed and its cursor does not move.
    """
    columns = flagged(TARGETS[object_type]).fieldNames()
    if mode == "fail":
        broken = F.raise_error(F.concat(F.lit("cannot stage message: "), F.col("reject_reason")))
        checked = F.when(F.col("reject_reason").isNotNull(), broken.cast("string"))
        return parsed.withColumn("reject_reason", checked).filter(F.col("reject_reason").isNull()).select(*columns)
    if mode != "quarantine":
        raise ValueError(f"unknown mode: {mode}")
    return parsed.filter(F.col("reject_reason").isNull()).select(*columns)


def rejected(parsed: DataFrame) -> DataFrame:
    """Coordinates of the messages that were set aside, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*COORDINATES, "reject_reason")


def route_counts(raw: DataFrame) -> DataFrame:
    """Messages per stream partition and destination; ``none`` for unknown types and broken text."""
    known = F.col("object_type").isin(TRANSACTION, CURRENCY)
    route = F.when(known, F.lower("object_type")).otherwise("none")
    return (
        parse_envelopes(raw, [])
        .groupBy("kafka_partition", route.alias("route"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )
