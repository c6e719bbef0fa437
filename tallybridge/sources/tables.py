"""Parameterised SQL over a DataFrame."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def bound_scan(spark: SparkSession, text: str, parameters: dict[str, Any], **tables: DataFrame) -> DataFrame:
    """Run ``text`` with typed ``:name`` parameters; ``{name}`` refers to a DataFrame.

    Parameters are bound as literals by the analyzer, never pasted into the text.
    """
    return spark.sql(text, args=parameters, **tables)
