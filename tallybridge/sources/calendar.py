"""Generated calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.days import DayLike, as_day


def day_range(spark: SparkSession, first: DayLike, last: DayLike, name: str = "date") -> DataFrame:
    """One row per day of the closed range; no rows when a bound is NULL."""
    span = F.sequence(as_day(first), as_day(last))
    return spark.range(1).select(F.explode(span).alias(name))


def calendar(days: DataFrame) -> DataFrame:
    """``date`` with its year, quarter and month."""
    day = F.col("date")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
    )
