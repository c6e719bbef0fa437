"""Domain inputs derived from the driver's ``events`` and ``nation`` tables.

Everything is a projection of one scan of ``events``: second deliveries come from
exploding a small array per row and rates from the distinct event days, so the work
grows with the tables and nothing is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import to_millis
from ..schemas import RATE, TRANSACTION_COLUMNS

TOPIC = "events"
# Fixed values of the derivation.
COUNTRY_BY_REMAINDER = ["russia", "usa", "italy", "china", "england", "turkey"]
RATE_EPOCH = "2024-01-01"
RATE_SLOTS = 16


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_days(spark: SparkSession, sf_dir: str, name: str = "rate_date") -> DataFrame:
    return events(spark, sf_dir).select(F.to_date("ts").alias(name)).distinct()


def _country(user: Column) -> Column:
    known = F.array(*[F.lit(c) for c in COUNTRY_BY_REMAINDER])
    remainder = (user % 7).cast("int")
    unnamed = F.when(user % 2 == 0, "lemuria").otherwise("atlantis")
    return F.when(remainder == 6, unnamed).otherwise(F.get(known, remainder))


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction, every tenth one delivered a second time."""
    user, event = F.col("user_id"), F.col("event_id")
    minor = F.round(F.col("value") * 100).cast("bigint")
    status = (
        F.when(F.col("event_type") == "signup", "queued")
        .when(F.col("event_type") == "error", "blocked")
        .otherwise("done")
    )
    return events(spark, sf_dir).select(
        event,
        F.explode(F.when(event % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("delivery"),
        F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(event.cast("string"), 12, "0")).alias("operation_id"),
        (user - 5).alias("account_number_from"),
        (F.get_json_object("props", "$.k").cast("bigint") - 3).alias("account_number_to"),
        (410 + 10 * (user % 7)).cast("int").alias("currency_code"),
        _country(user).alias("country"),
        status.alias("status"),
        F.col("event_type").alias("transaction_type"),
        F.when(event % 3 == 0, -minor).otherwise(minor).alias("amount"),
        to_millis(F.col("ts").cast("timestamp")).alias("transaction_dt"),
    )


def staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the staging transactions table, copies included."""
    return _deliveries(spark, sf_dir).select(*TRANSACTION_COLUMNS, F.to_date("transaction_dt").alias("p_date"))


def _rate_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day x currency x target, numbered within the day.

    The nations concerned are at most seven primary keys, so they travel as one array.
    """
    nation = spark.read.schema("n_nationkey int").parquet(f"{sf_dir}/nation.parquet")
    codes = nation.filter("n_nationkey < 7 AND n_nationkey <> 1").agg(F.collect_set("n_nationkey"))
    day, code = F.col("rate_date"), F.col("code")
    regular = F.transform(
        F.array(F.lit(420), F.lit(430)),
        lambda target: F.struct(
            target.alias("target"),
            (F.lit("0.25").cast(RATE) + F.lit("0.125").cast(RATE) * code).cast(RATE).alias("rate"),
            F.lit(0).alias("hour"),
        ),
    )
    second = F.array(F.struct(F.lit(420).alias("target"), F.lit("0.9").cast(RATE).alias("rate"), F.lit(12).alias("hour")))
    offered = (
        F.when((code == 6) & (F.dayofmonth(day) % 2 == 0), F.slice(regular, 1, 0))
        .when((code == 5) & (F.dayofmonth(day) % 10 == 0), F.concat(regular, second))
        .otherwise(regular)
    )
    return (
        event_days(spark, sf_dir)
        .select(day, F.explode(codes.scalar()).alias("code"))
        .select(day, code, F.posexplode(offered).alias("position", "offer"))
        .select(
            F.expr("timestampadd(HOUR, offer.hour, cast(rate_date AS TIMESTAMP))").alias("date_update"),
            (410 + 10 * code).cast("int").alias("currency_code"),
            F.col("offer.target").alias("currency_code_with"),
            F.col("offer.rate").alias("currency_with_div"),
            # 7 currencies x 2 targets fill slots 0-13, the second offer takes slot 14.
            (
                F.datediff(day, F.lit(RATE_EPOCH).cast("date")) * RATE_SLOTS
                + F.when(F.col("position") == 2, 14).otherwise(code * 2 + F.col("position"))
            )
            .cast("bigint")
            .alias("slot"),
        )
    )


def staged_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the staging currencies table."""
    return _rate_slots(spark, sf_dir).drop("slot").withColumn("p_date", F.to_date("date_update"))


def _millis_text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS").alias(moment)


def _envelope(kind: str, *fields: Column | str) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("object_type"), F.struct(*fields).alias("payload")))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream records with the columns of the Kafka source."""
    event = F.col("event_id")
    again = F.col("delivery") == 1
    moved = _deliveries(spark, sf_dir).select(
        F.lit(TOPIC).alias("topic"),
        F.when(again, F.lit(4)).otherwise((event % 3).cast("int")).alias("partition"),
        F.when(again, F.expr("event_id div 10")).otherwise(F.expr("event_id div 3")).alias("offset"),
        F.col("transaction_dt").alias("timestamp"),
        _envelope("TRANSACTION", *TRANSACTION_COLUMNS[:-1], _millis_text("transaction_dt")).cast("binary").alias("value"),
    )
    quoted = _rate_slots(spark, sf_dir).select(
        F.lit(TOPIC).alias("topic"),
        F.lit(3).alias("partition"),
        F.col("slot").alias("offset"),
        F.col("date_update").alias("timestamp"),
        _envelope(
            "CURRENCY", _millis_text("date_update"), "currency_code", "currency_code_with", "currency_with_div"
        ).cast("binary").alias("value"),
    )
    return moved.unionByName(quoted)
