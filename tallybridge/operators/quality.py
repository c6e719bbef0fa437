"""Readiness and data-quality checks, for one day or grouped over many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.days import DayLike, as_day
from ..schemas import BASE_CURRENCY
from .cleaning import base_rates, done_only


def latest_day(staged: DataFrame, name: str) -> DataFrame:
    """One row; NULL for an empty table. Only the day column is read."""
    return staged.agg(F.max("p_date").alias(name))


def latest_days(transactions: DataFrame, rates: DataFrame) -> DataFrame:
    """Latest staged transaction and rate day, as one row."""
    moved = latest_day(transactions, "latest_transaction_date")
    return moved.select("*", latest_day(rates, "latest_rate_date").scalar().alias("latest_rate_date"))


def day_readiness(days: DataFrame, transactions: DataFrame, rates: DataFrame) -> DataFrame:
    """A day is complete once both tables hold a later day; never while one is empty."""
    moved = latest_day(transactions, "latest").scalar()
    quoted = latest_day(rates, "latest").scalar()
    named = days.select("process_date", moved.alias("latest_transaction_date"), quoted.alias("latest_rate_date"))
    closed = F.least("latest_transaction_date", "latest_rate_date") > F.col("process_date")
    both = F.col("latest_transaction_date").isNotNull() & F.col("latest_rate_date").isNotNull()
    return named.withColumn("ready", both & F.coalesce(closed, F.lit(False)))


def holds_day(df: DataFrame, day_column: str, day: DayLike) -> bool:
    """Whether a day has any row; stops at the first one found."""
    return not df.filter(F.col(day_column) == as_day(day)).limit(1).isEmpty()


def days_present(days: DataFrame, clean: DataFrame, rates: DataFrame) -> DataFrame:
    """Per day of ``days(process_date)``: are there transactions, are there rates."""
    moved = clean.select(F.col("p_date").alias("process_date")).distinct().withColumn("moved", F.lit(True))
    quoted = rates.select(F.col("rate_date").alias("process_date")).distinct().withColumn("quoted", F.lit(True))
    return (
        days.join(moved, "process_date", "left")
        .join(quoted, "process_date", "left")
        .select(
            "process_date",
            F.coalesce("moved", F.lit(False)).alias("has_transactions"),
            F.coalesce("quoted", F.lit(False)).alias("has_currencies"),
        )
    )


def missing_rates(clean: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Days and currencies with completed transactions but no direct rate into the base."""
    traded = done_only(clean).select(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from"))
    return unrated(traded.distinct(), rates, base).orderBy("process_date", "currency_from")


def unrated(turnovers: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """The same from turnovers, which have a row per day and currency."""
    traded = turnovers.filter(F.col("currency_from") != base).select(F.col("date_update").alias("process_date"), "currency_from")
    direct = rates.filter(F.col("currency_to") == base).select(
        F.col("rate_date").alias("process_date"), "currency_from"
    )
    return traded.join(direct, ["process_date", "currency_from"], "left_anti")


def ambiguous_rates(rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Days and currencies with several direct rates; each rate gives its own mart row."""
    return (
        base_rates(rates, base)
        .groupBy("rate_date", "currency_from")
        .agg(
            F.count(F.lit(1)).alias("rate_count"),
            F.min("currency_rate").alias("lowest_rate"),
            F.max("currency_rate").alias("highest_rate"),
        )
        .filter(F.col("rate_count") > 1)
    )


def quality_report(days: DataFrame, clean: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """All checks of a range as one row per day."""
    unrated = missing_rates(clean, rates, base).groupBy("process_date").agg(F.count(F.lit(1)).alias("unrated"))
    return days_present(days, clean, rates).join(unrated, "process_date", "left").select(
        "process_date",
        "has_transactions",
        "has_currencies",
        F.coalesce("unrated", F.lit(0)).cast("bigint").alias("missing_rates"),
    )


def late_days(loads: DataFrame, seen: DataFrame) -> DataFrame:
    """Days with committed loads that no build of the day saw, and how many.

    Both sides hold (target, load_id, process_date), a row per load and day; no staged row is read.
    """
    keys = ["target", "load_id", "process_date"]
    unseen = loads.select(*keys).distinct().join(seen.select(*keys), keys, "left_anti")
    return unseen.groupBy("process_date").agg(F.count(F.lit(1)).alias("late_loads"))
