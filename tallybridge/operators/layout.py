"""Clustering by several columns: neighbouring rows in a file are near in all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits that a column's place among all values is told with.
BITS = 6


def _number(df: DataFrame, column: str) -> Column:
    """A column as a number in its order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    return F.col(column).cast("bigint" if isinstance(kind, T.IntegralType) else "double")


def bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """The values that part each column into 2**bits shares of about equal size: 63 numbers a column at most, in one pass."""
    shares = [n / (1 << bits) for n in range(1, 1 << bits)]
    told = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(c) for c in columns]).first()
    return {c: sorted(set(told[c] or [])) for c in columns}


def place(value: Column, limits: Sequence) -> Column:
    """How many of the sorted ``limits`` are at most ``value``, by halving; null comes first."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(limits[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(between(0, len(limits)))


def interleaved(df: DataFrame, limits: dict[str, list], bits: int = BITS) -> Column:
    """One key from the places of several columns, their bits in turn from the highest."""
    key, count = F.lit(0).cast("bigint"), len(limits)
    for n, (column, own) in enumerate(limits.items()):
        at = place(_number(df, column), own).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(at, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * count + count - 1 - n))
    return key
