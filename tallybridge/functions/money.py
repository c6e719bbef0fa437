"""Exact conversion of minor units into the base currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minor_to_base(minor_units: Column, rate: Column) -> Column:
    """``round(minor / 100 * rate, 2)``, half up, without leaving decimals.

    A whole number of minor units times a rate with 8 decimals fits DECIMAL(38,8)
    for every 64-bit sum, and its unit is already the cent: rounding to whole
    cents and shifting by two places equals rounding the quotient to two places.
    """
    cents = F.round(minor_units.cast("decimal(19,0)") * rate.cast("decimal(18,8)"), 0)
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")
