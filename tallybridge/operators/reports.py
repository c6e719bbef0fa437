"""BI surface: the gap-filled view and the dashboard figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.days import DayLike, as_day
from ..schemas import MONEY
from .cleaning import done_only
from .metrics import date_bounds

VIEW_KEYS = ["date_update", "year", "quarter", "month", "currency_from", "currency_iso_code", "country"]


def calendar_by_currency(calendar: DataFrame, currencies: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every calendar day within ``bounds(first_day, last_day)`` for every currency row.

    Each currency row unfolds into the days between the bounds and meets the calendar by
    date. That is the same spine as a cross join, with an equi join as its only join, and
    no days at all when the bounds are NULL.
    """
    span = F.sequence(bounds.select("first_day").scalar(), bounds.select("last_day").scalar())
    unfolded = currencies.select("currency_code", "currency_iso_code", "country", F.explode(span).alias("date"))
    return unfolded.join(calendar, "date").select(
        F.col("date").alias("date_update"),
        "year",
        "quarter",
        "month",
        F.col("currency_code").alias("currency_from"),
        "currency_iso_code",
        "country",
    )


def gap_filled(mart: DataFrame, calendar: DataFrame, currencies: DataFrame) -> DataFrame:
    """The mart on the full spine, zeros where a day has no transactions in a currency."""
    spine = calendar_by_currency(calendar, currencies, date_bounds(mart))
    zero = F.lit(0)
    return spine.join(mart, ["date_update", "currency_from"], "left").select(
        *VIEW_KEYS,
        F.coalesce("amount_total", zero.cast(MONEY)).alias("amount_total"),
        F.coalesce("cnt_transactions", zero.cast("bigint")).alias("cnt_transactions"),
        F.coalesce("avg_transactions_per_account", F.lit(0.0)).alias("avg_transactions_per_account"),
        F.coalesce("cnt_accounts_make_transactions", zero.cast("bigint")).alias("cnt_accounts_make_transactions"),
    )


def dashboard_slice(
    view: DataFrame, first: DayLike, last: DayLike, currencies: Sequence[int] | None = None
) -> DataFrame:
    """The dashboard's date and currency filters."""
    chosen = view.filter(F.col("date_update").between(as_day(first), as_day(last)))
    return chosen.filter(F.col("currency_from").isin(*currencies)) if currencies else chosen


def dashboard_totals(clean: DataFrame, mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Volume, transactions, unique users and transactions per user, overall or ``by`` a mart key.

    Volume adds up over the mart. Users do not: one user is active on many days and in
    many currencies, so they are counted again from the transactions behind the mart's
    rows. The semi join keeps that to days and currencies the mart holds.
    """
    keys = ["date_update", "currency_from"]
    behind = (
        done_only(clean)
        .select(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from"), "account_number_from")
        .groupBy(*keys, "account_number_from")
        .agg(F.count(F.lit(1)).alias("transactions"))
        .join(mart.select(*keys), keys, "left_semi")
    )
    users = (
        behind.groupBy(*by, "account_number_from")
        .agg(F.sum("transactions").alias("transactions"))
        .groupBy(*by)
        .agg(F.sum("transactions").alias("cnt_transactions"), F.count(F.lit(1)).alias("unique_users"))
    )
    volume = mart.groupBy(*by).agg(F.sum("amount_total").cast("decimal(28,2)").alias("amount_total"))
    if by:
        joined = volume.join(users, list(by))
    else:
        # Both sides are one row, met through the constant key.
        joined = volume.withColumn("one", F.lit(1)).join(users.withColumn("one", F.lit(1)), "one")
    return joined.select(
        *by,
        "amount_total",
        "cnt_transactions",
        "unique_users",
        (F.col("cnt_transactions") / F.col("unique_users")).alias("avg_transactions_per_user"),
    )
