"""Currency and calendar dimensions; both only ever gain rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ISO_BY_COUNTRY, UNKNOWN_ISO
from ..sources.calendar import calendar


def iso_code(country: Column) -> Column:
    pairs = [F.lit(text) for pair in ISO_BY_COUNTRY.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), country), F.lit(UNKNOWN_ISO))


def _first_seen(clean: DataFrame) -> DataFrame:
    """First day of each (code, country): the fact table shrinks to this before any join."""
    return clean.groupBy("currency_code", "country").agg(F.min("p_date").alias("first_day"))


def new_currencies(clean: DataFrame, existing: DataFrame) -> DataFrame:
    """Dimension rows for codes that are not in ``existing``.

    A code enters with every country it has on the first day it appears and is closed
    afterwards, so a range of days gives what running the days one by one gives.
    """
    seen = _first_seen(clean).join(existing.select("currency_code"), "currency_code", "left_anti")
    opening = seen.groupBy("currency_code").agg(F.min("first_day").alias("first_day"))
    return seen.join(opening, ["currency_code", "first_day"]).select(
        "currency_code", "country", iso_code(F.col("country")).alias("currency_iso_code")
    )


def currency_conflicts(dimension: DataFrame) -> DataFrame:
    """Codes with more than one row; each doubles that currency in the gap-filled view."""
    counted = dimension.groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("country").alias("first_country"), F.max("country").alias("last_country")
    )
    return counted.filter(F.col("row_count") > 1)


def new_calendar_days(days: DataFrame, existing: DataFrame) -> DataFrame:
    """Calendar rows for dates that are not in ``existing``."""
    return calendar(days.join(existing.select("date"), "date", "left_anti"))
