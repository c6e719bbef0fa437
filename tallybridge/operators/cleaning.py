"""DDS layer: clean transactions and rates at day grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ALL_RATES, BASE_CURRENCY, DDS_CURRENCIES, DONE, LATEST_RATE, TRANSACTION_COLUMNS


def clean_transactions(staged: DataFrame) -> DataFrame:
    """Distinct rows of real accounts, with the day column.

    Whole rows are compared: rows that share an id but differ elsewhere all stay. The
    filter and the partial aggregate run before the shuffle, so copies of one row leave
    a task as one row however many there are.
    """
    real = (F.col("account_number_from") >= 0) & (F.col("account_number_to") >= 0)
    distinct = staged.filter(real).select(*TRANSACTION_COLUMNS).distinct()
    return distinct.withColumn("p_date", F.to_date("transaction_dt"))


def normalize_rates(staged: DataFrame, rate_policy: str = ALL_RATES) -> DataFrame:
    """Rates per day: equal rates of one day collapse, differing ones stay.

    With the policy ``latest`` only the last one of each pair of currencies stays, the higher of
    two of the same moment.
    """
    if rate_policy not in (ALL_RATES, LATEST_RATE):
        raise ValueError(f"unknown rate policy: {rate_policy}")
    dated = staged.select(
        F.to_date("date_update").alias("rate_date"),
        F.col("currency_code").alias("currency_from"),
        F.col("currency_code_with").alias("currency_to"),
        F.col("currency_with_div").alias("currency_rate"),
        "date_update",
    )
    columns = DDS_CURRENCIES.fieldNames()
    if rate_policy == LATEST_RATE:
        last = F.max(F.struct("date_update", "currency_rate")).alias("last")
        return dated.groupBy(*columns[:3]).agg(last).select(*columns[:3], "last.currency_rate")
    return dated.select(*columns).distinct()


def done_only(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("status") == DONE)


def base_rates(rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Direct rates into the base currency; nothing is derived through a third currency."""
    direct = rates.filter(F.col("currency_to") == base)
    return direct.select("rate_date", "currency_from", "currency_rate").distinct()


def rates_with_base(rates: DataFrame, days: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """For every day of ``days(rate_date)``: its direct rates and the base currency at 1.

    The added row stands next to a stored base-to-base rate, if there is one.
    """
    unit = days.select(
        "rate_date",
        F.lit(base).cast("int").alias("currency_from"),
        F.lit(1).cast("decimal(18,8)").alias("currency_rate"),
    )
    return base_rates(rates, base).join(days, "rate_date", "left_semi").unionByName(unit)
