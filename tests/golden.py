"""The micro-fixture: ten transactions and six rates with known results at every layer."""

from datetime import datetime
from decimal import Decimal

from tallybridge import schemas


def uid(short: str) -> str:
    return f"00000000-0000-0000-0000-0000000000{short}"


def _tx(short, sender, receiver, code, country, status, kind, amount, moment):
    return (uid(short), sender, receiver, code, country, status, kind, amount, datetime.fromisoformat(moment))


TRANSACTIONS = [
    _tx("a1", 1001, 2001, 430, "italy", "done", "c2a_incoming", 10000, "2022-10-01 10:00:00"),
    _tx("a1", 1001, 2001, 430, "italy", "done", "c2a_incoming", 10000, "2022-10-01 10:00:00"),
    _tx("a2", 1001, 2002, 430, "italy", "done", "sbp_outgoing", -2550, "2022-10-01 11:00:00"),
    _tx("a3", 1002, 2001, 430, "italy", "queued", "sbp_outgoing", 999, "2022-10-01 11:30:00"),
    _tx("a4", 1003, 2001, 420, "usa", "done", "transfer", 333, "2022-10-01 23:59:59.999"),
    _tx("a5", -7, 2001, 430, "italy", "done", "transfer", 500, "2022-10-01 12:00:00"),
    _tx("a6", 1001, -9, 430, "italy", "done", "transfer", 500, "2022-10-01 12:00:00"),
    _tx("a7", 1004, 2001, 470, "atlantis", "done", "transfer", 700, "2022-10-01 13:00:00"),
    _tx("a8", 1005, 2001, 450, "turkey", "done", "transfer", 101, "2022-10-01 14:00:00"),
    _tx("a9", 1005, 2001, 430, "italy", "done", "transfer", 400, "2022-10-02 00:00:00"),
]


def _rate(moment, code, target, rate):
    return (datetime.fromisoformat(moment), code, target, Decimal(rate))


RATES = [
    _rate("2022-10-01 00:00:00", 430, 420, "0.98"),
    _rate("2022-10-01 09:00:00", 430, 420, "0.98"),
    _rate("2022-10-01 00:00:00", 430, 450, "18.1"),
    _rate("2022-10-01 00:00:00", 450, 420, "0.05"),
    _rate("2022-10-01 12:00:00", 450, 420, "0.06"),
    _rate("2022-10-02 00:00:00", 430, 420, "0.97"),
]

MART = [
    (420, Decimal("3.33"), 1, 1.0, 1),
    (430, Decimal("122.99"), 2, 2.0, 1),
    (450, Decimal("0.05"), 1, 1.0, 1),
    (450, Decimal("0.06"), 1, 1.0, 1),
]

DIMENSION = [(420, "usa", "USD"), (430, "italy", "EUR"), (450, "turkey", "TRY"), (470, "atlantis", "UNKNOWN")]


def staged(spark):
    """(transactions, rates) as staging frames with the day column."""
    from tallybridge.functions.days import with_day

    # Naive times are taken as UTC, whatever zone Python runs in.
    tx = spark.createDataFrame([(*t[:-1], str(t[-1])) for t in TRANSACTIONS], schemas.TRANSACTIONS.simpleString()
                               .replace("timestamp", "string")).withColumn("transaction_dt", _utc("transaction_dt"))
    fx = spark.createDataFrame([(str(r[0]), *r[1:]) for r in RATES], schemas.STG_CURRENCIES.simpleString()
                               .replace("timestamp", "string")).withColumn("date_update", _utc("date_update"))
    return with_day(tx, "transaction_dt"), with_day(fx, "date_update")


def _utc(name):
    from pyspark.sql import functions as F

    return F.col(name).cast("timestamp")
