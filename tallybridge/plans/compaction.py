"""Small files of landings and staging loads, packed into files of advisory size.

Every landing and every load leaves a file or more in each partition that it touches. Here partitions with
several small ones are written anew, all in one job, and then pointed at their new folder. Rows
stay the same, so it makes no difference to a reader which of the two it sees. Appends made
while a partition is written anew would be lost: no landing or load of that table may run at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .partitions import SORT_KEYS, point_partitions
from .warehouse import SWITCHED, TABLES, Warehouse

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
COMPACTED_KEYS = {"raw.kafka_events": ["kafka_offset"], **SORT_KEYS}


@dataclass(frozen=True)
class Packed:
    """Partitions that were written anew, and their files before and after."""

    partitions: int
    files_before: int
    files_after: int


def bytes_of(setting: str) -> int:
    """A size as Spark spells it: a number and at most a unit."""
    text = setting.strip().lower().removesuffix("b")
    unit = text[-1:] if text[-1:] in "kmgtp" else ""
    return int(text.removesuffix(unit)) * 1024 ** " kmgtp".index(unit or " ")


def files(warehouse: Warehouse, table: str) -> DataFrame:
    """A row per file of a table, with its partition and size; no column of the data is read."""
    columns = list(TABLES[table][1])
    told = warehouse.table(table).select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    return told.groupBy(*columns, "file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))


def scattered(warehouse: Warehouse, table: str, advisory: int) -> DataFrame:
    """Partitions whose files would be fewer: those with two or more below half of the advisory size that fit together."""
    small = F.col("size") < advisory // 2
    found = files(warehouse, table).groupBy(*TABLES[table][1]).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(small).alias("small"), F.sum("size").alias("bytes")
    )
    return found.filter((F.col("small") > 1) & (F.col("files") > F.ceil(F.col("bytes") / F.lit(advisory))))


def _same(columns: list[str], row) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns])


def compact(warehouse: Warehouse, table: str, advisory: int | None = None, at_once: int = 1000) -> Packed:
    """Write the scattered partitions of a table anew, up to ``at_once`` of them in a run.

    Rows are rebalanced by partition, so a large one is split at the advisory size and a small one is a
    single file, and sorted as the table is. What is not scattered is not read. Only a
    finished write moves pointers; a failed run changes nothing.
    """
    if table in SWITCHED:
        raise ValueError(f"the days of {table} are replaced as a whole, in files of advisory size")
    spark, columns = warehouse.spark, list(TABLES[table][1])
    advisory = advisory or bytes_of(spark.conf.get(ADVISORY))
    # Most scattered first; partitions are named one by one, a bounded number at a time.
    chosen = scattered(warehouse, table, advisory).orderBy(F.desc("files")).limit(at_once).collect()
    if not chosen:
        return Packed(0, 0, 0)
    wanted = reduce(lambda a, b: a | b, [_same(columns, r) for r in chosen])
    folder = warehouse.fresh_location(table)
    rows = warehouse.table(table).filter(wanted).select(*warehouse.columns(table))
    laid = rows.hint("rebalance", *columns).sortWithinPartitions(*columns, *COMPACTED_KEYS[table])
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, str(advisory))
    try:
        laid.write.partitionBy(*columns).parquet(folder)
    finally:
        spark.conf.set(ADVISORY, before)
    names = {tuple(r[c] for c in columns) for r in chosen}
    places = {name: f"{folder}/{name}" for name in warehouse.partitions(table) if warehouse.values_of(table, name) in names}
    point_partitions(warehouse, table, places)
    after = files(warehouse, table).filter(wanted).count()
    return Packed(len(places), sum(r.files for r in chosen), after)
