"""Declared schemas and fixed domain values. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Fixed values that results depend on.
BASE_CURRENCY = 420
DONE = "done"
TRANSACTION = "TRANSACTION"
CURRENCY = "CURRENCY"
ZERO_UUID = "00000000-0000-0000-0000-000000000000"
UNKNOWN_ISO = "UNKNOWN"
ISO_BY_COUNTRY = {
    "canada": "CAD",
    "usa": "USD",
    "russia": "RUB",
    "italy": "EUR",
    "china": "CNY",
    "england": "GBP",
    "turkey": "TRY",
}
CALENDAR_FROM = "2022-01-01"
CALENDAR_TO = "2031-12-31"
FLUSH_ROWS = 5000
FLUSH_SECONDS = 30
STAGING_BATCH = 10_000

RATE = T.DecimalType(18, 8)
MONEY = T.DecimalType(18, 2)

COORDINATES = ["kafka_topic", "kafka_partition", "kafka_offset"]

RAW = _struct(
    kafka_topic=T.StringType(),
    kafka_partition=T.IntegerType(),
    kafka_offset=T.LongType(),
    kafka_message=T.StringType(),
)

TRANSACTIONS = _struct(
    operation_id=T.StringType(),
    account_number_from=T.LongType(),
    account_number_to=T.LongType(),
    currency_code=T.IntegerType(),
    country=T.StringType(),
    status=T.StringType(),
    transaction_type=T.StringType(),
    amount=T.LongType(),
    transaction_dt=T.TimestampType(),
)

STG_CURRENCIES = _struct(
    date_update=T.TimestampType(),
    currency_code=T.IntegerType(),
    currency_code_with=T.IntegerType(),
    currency_with_div=RATE,
)

DDS_CURRENCIES = _struct(
    rate_date=T.DateType(),
    currency_from=T.IntegerType(),
    currency_to=T.IntegerType(),
    currency_rate=RATE,
)

DIM_CURRENCY = _struct(
    currency_code=T.IntegerType(),
    country=T.StringType(),
    currency_iso_code=T.StringType(),
)

DIM_CALENDAR = _struct(
    date=T.DateType(),
    year=T.IntegerType(),
    quarter=T.IntegerType(),
    month=T.IntegerType(),
)

GLOBAL_METRICS = _struct(
    date_update=T.DateType(),
    currency_from=T.IntegerType(),
    amount_total=MONEY,
    cnt_transactions=T.LongType(),
    avg_transactions_per_account=T.DoubleType(),
    cnt_accounts_make_transactions=T.LongType(),
)

MISSING_RATES = _struct(process_date=T.DateType(), currency_from=T.IntegerType())

# Counts of distinct rows and of their senders, as changes under the id of the batch that made them.
ROW_COPIES = T.StructType(
    [*TRANSACTIONS.fields, *_struct(bucket=T.IntegerType(), change=T.LongType(), delta_id=T.StringType()).fields]
)
SENDER_ROWS = _struct(
    currency_code=T.IntegerType(),
    account_number_from=T.LongType(),
    bucket=T.IntegerType(),
    transactions=T.LongType(),
    minor_units=T.LongType(),
    delta_id=T.StringType(),
)
TURNOVER_CHANGES = _struct(
    currency_code=T.IntegerType(),
    minor_units=T.LongType(),
    cnt_transactions=T.LongType(),
    cnt_accounts=T.LongType(),
    delta_id=T.StringType(),
)
DELTAS = _struct(delta_id=T.StringType(), rows=T.LongType(), senders=T.LongType())

DIM_ACCOUNT = _struct(account_number=T.LongType(), account_id=T.LongType())
SENDER_BITS = _struct(
    date_update=T.DateType(), currency_from=T.IntegerType(), bucket=T.LongType(), bits=T.BinaryType()
)
MART_BOUNDS = _struct(first_day=T.DateType(), last_day=T.DateType())

CURSORS = _struct(
    target=T.StringType(),
    kafka_topic=T.StringType(),
    kafka_partition=T.IntegerType(),
    offset_to=T.LongType(),
)

# What a named backfill has finished, by layer and day.
BACKFILL_JOURNAL = _struct(
    backfill=T.StringType(),
    layer=T.StringType(),
    process_date=T.DateType(),
    status=T.StringType(),
    reason=T.StringType(),
)

BUILD_LOG = _struct(
    layer=T.StringType(),
    process_date=T.DateType(),
    status=T.StringType(),
)

# Offsets of a stream partition that a landing claims (begun) and holds (landed).
RAW_LOADS = _struct(
    load_id=T.StringType(),
    kafka_topic=T.StringType(),
    kafka_partition=T.IntegerType(),
    first_offset=T.LongType(),
    last_offset=T.LongType(),
    received=T.LongType(),
    state=T.StringType(),
)
BEGUN, LANDED = "begun", "landed"

# Ranges of offsets that a landing found in its batch and that RAW holds since.
LOAD_RUNS = _struct(
    load_id=T.StringType(),
    kafka_topic=T.StringType(),
    kafka_partition=T.IntegerType(),
    first_offset=T.LongType(),
    last_offset=T.LongType(),
)

BATCH_STATS = _struct(
    load_id=T.StringType(),
    received=T.LongType(),
    saved=T.LongType(),
    duplicates=T.LongType(),
    unreadable=T.LongType(),
)

# Days that a committed staging load brought rows for, and the loads that a day's build saw.
STAGED_LOADS = _struct(target=T.StringType(), load_id=T.StringType(), process_date=T.DateType())
SEEN_LOADS = STAGED_LOADS

# A rate may be one of several for its day; all of them or the last one count.
ALL_RATES, LATEST_RATE = "all", "latest"

TRANSACTION_COLUMNS = TRANSACTIONS.fieldNames()


def flagged(columns: T.StructType) -> T.StructType:
    """A staging table's columns: the target's and whether a field was defaulted or altered."""
    return T.StructType([*columns.fields, T.StructField("had_missing", T.BooleanType())])


def envelope(payload_fields: list[str]) -> T.StructType:
    """Message schema with text leaves: raw text survives, so coercion is ours to decide.

    ``broken`` receives the text of a message that is no valid JSON to its end; without
    it the parser would hand out the fields it met before the break.
    """
    payload = T.StructType([T.StructField(name, T.StringType()) for name in payload_fields])
    return _struct(object_type=T.StringType(), payload=payload, broken=T.StringType())
