"""CDM layer: metrics per day and currency, in the base currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import minor_to_base
from ..schemas import BASE_CURRENCY, GLOBAL_METRICS
from .cleaning import done_only, rates_with_base


def turnover(clean: DataFrame) -> DataFrame:
    """Turnover, transactions and exact distinct senders of completed transactions.

    Grouped by sender first. The shuffle key then holds the account, so a currency
    that has a third of all rows spreads over the cluster, and an account that has a
    third of them is already one row per task. The second step sees one row per
    account and again combines before its shuffle.
    """
    per_account = (
        done_only(clean)
        .groupBy(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from"), "account_number_from")
        .agg(F.sum(F.abs("amount")).alias("minor_units"), F.count(F.lit(1)).alias("transactions"))
    )
    return per_account.groupBy("date_update", "currency_from").agg(
        F.sum("minor_units").alias("minor_units"),
        F.sum("transactions").alias("cnt_transactions"),
        F.count(F.lit(1)).alias("cnt_accounts_make_transactions"),
    )


def to_base_currency(turnovers: DataFrame, rates: DataFrame) -> DataFrame:
    """Turnovers joined with rates: unrated currencies drop out, several rates give several rows.

    Both sides are aggregates by now. No hint: AQE broadcasts a side only if its
    measured size allows.
    """
    accounts = F.col("cnt_accounts_make_transactions")
    mean = F.when(accounts == 0, F.lit(0.0)).otherwise(F.col("cnt_transactions") / accounts)
    dated = rates.withColumnRenamed("rate_date", "date_update")
    return turnovers.join(dated, ["date_update", "currency_from"]).select(
        "date_update",
        "currency_from",
        minor_to_base(F.col("minor_units"), F.col("currency_rate")).alias("amount_total"),
        "cnt_transactions",
        mean.cast("double").alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
    )


def global_metrics(clean: DataFrame, rates: DataFrame, days: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """The mart for the days of ``days(rate_date)``."""
    rated = rates_with_base(rates, days, base)
    return to_base_currency(turnover(clean), rated).select(*GLOBAL_METRICS.fieldNames())


def date_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("date_update").alias("first_day"), F.max("date_update").alias("last_day"))
