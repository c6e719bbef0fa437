"""Days laid out so that a scan by any of several columns finds its rows in few files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import layout
from .partitions import places, switch
from .warehouse import Warehouse

KEY = "cluster_key"


def clustered(df: DataFrame, columns: Sequence[str], files_a_day: int | None = None) -> DataFrame:
    """Rows dealt out by ranges of day and interleaved key, and sorted by it; a file covers a small box of the columns.

    Without ``files_a_day`` AQE joins neighbouring ranges up to its advisory size.
    """
    limits = layout.bounds(df, columns)
    keyed = df.withColumn(KEY, layout.interleaved(df, limits))
    by = [F.col("p_date"), F.col(KEY), *map(F.col, columns)]
    if files_a_day is None:
        dealt = keyed.repartitionByRange(*by)
    else:
        dealt = keyed.repartitionByRange(files_a_day * max(1, df.select("p_date").distinct().count()), *by)
    return dealt.sortWithinPartitions(*by).drop(KEY)


def cluster_days(
    warehouse: Warehouse, table: str, days: Sequence[date], columns: Sequence[str], files_a_day: int | None = None
) -> None:
    """Write ``days`` of a table anew in that layout, and switch to it at once; the rows are the same."""
    held = places(warehouse, table)
    chosen = [d for d in days if str(d) in held]
    if not chosen:
        return
    folder = warehouse.fresh_location(table)
    rows = warehouse.table(table).filter(F.col("p_date").isin(*chosen)).select(*warehouse.columns(table))
    clustered(rows, columns, files_a_day).write.partitionBy("p_date").parquet(folder)
    switch(warehouse, table, held | {str(d): f"{folder}/p_date={d}" for d in chosen})


def files_with(warehouse: Warehouse, table: str, column: str, value) -> tuple[int, int]:
    """Files whose lowest and highest value of a column enclose ``value``, which a scan for it has to read, and all files."""
    held = warehouse.spark.table(warehouse.held(table))
    spans = held.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    met = F.lit(value).between(F.col("low"), F.col("high"))
    return tuple(spans.agg(F.count_if(met), F.count(F.lit(1))).first())
