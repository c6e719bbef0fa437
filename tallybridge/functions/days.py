"""Day partitions: ids, half-open day ranges and the pruning slice."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DayLike = date | str | Column


def as_day(value: DayLike) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def partition_id(day: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def within_days(moment: Column, first: DayLike, last: DayLike | None = None) -> Column:
    """``first 00:00 <= moment < day after last 00:00`` in UTC."""
    first_day = as_day(first)
    last_day = first_day if last is None else as_day(last)
    return (moment >= first_day.cast("timestamp")) & (moment < F.date_add(last_day, 1).cast("timestamp"))


def day_slice(df: DataFrame, moment: str, first: DayLike, last: DayLike | None = None) -> DataFrame:
    """Rows of a day or a closed range of days.

    A range on the timestamp alone does not prune directories, so the partition
    column carries the same range when the table has one.
    """
    if "p_date" in df.columns:
        last_day = as_day(first) if last is None else as_day(last)
        df = df.filter(F.col("p_date").between(as_day(first), last_day))
    return df.filter(within_days(F.col(moment), first, last))


def with_day(df: DataFrame, moment: str) -> DataFrame:
    """The partition column of a table that is split by event day."""
    return df.withColumn("p_date", F.to_date(moment))
