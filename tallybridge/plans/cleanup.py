"""Files that no reader can reach any more: days of dropped versions, partitions that were packed, runs that failed.

Replacing days and packing files only ever add folders and move pointers, so that a running reader
keeps its files. Here the folders that no table in the catalog shows are found by an anti join of what is
stored against what is shown, and removed. No build, load, landing or packing of that table may run meanwhile, and
readers that planned before the last versions lose their files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partitions import kept_versions
from .warehouse import SWITCHED, TABLES, Warehouse

STORED = "folder string, shown_as string, files bigint, bytes bigint, newest timestamp"


@dataclass(frozen=True)
class Removed:
    """What one run has removed."""

    folders: int
    files: int
    bytes: int


def stored_folders(warehouse: Warehouse, place: str) -> DataFrame:
    """A row per folder below ``place`` that holds files, from its listing alone; no file is opened.

    ``newest`` is that of the whole run the folder belongs to, so a run that is still being written is new.
    """
    spark = warehouse.spark
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(place)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)
    folder = lambda path: F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    found = listed.select("path", F.col("_metadata.file_path").alias("shown"), "length", "modificationTime")
    found = found.groupBy(folder(F.col("path")).alias("folder"), folder(F.col("shown")).alias("shown_as")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("newest")
    )
    run = F.regexp_extract("folder", "^(.*__runs/[^/]*)", 1)
    run = F.when(run == "", F.col("folder")).otherwise(run).alias("run")
    newest = found.groupBy(run).agg(F.max("newest").alias("newest"))
    return found.drop("newest").withColumn("run", run).join(newest, "run").select("folder", "shown_as", "files", "bytes", "newest")


def shown_folders(warehouse: Warehouse, table: str) -> DataFrame:
    """The folders of files that a table, or any version of it in the catalog, shows."""
    tables = kept_versions(warehouse, table) if table in SWITCHED else [warehouse.name(table)]
    seen = [warehouse.spark.table(name).select(F.col("_metadata.file_path").alias("path")) for name in tables]
    path = reduce(DataFrame.union, seen)
    return path.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("shown_as")).distinct()


def unreachable(warehouse: Warehouse, table: str, before: datetime) -> DataFrame:
    """The stored folders of a table that nothing shows and that were left alone since ``before``."""
    if not TABLES[table][1]:
        raise ValueError(f"{table} has no partitions, so nothing of it is ever replaced")
    before = before if before.tzinfo else before.replace(tzinfo=UTC)
    place = warehouse.location(table)
    stored = stored_folders(warehouse, f"{place}__runs")
    if table in SWITCHED:
        lists = stored_folders(warehouse, f"{place}__versions")
        present = [name.rsplit("__", 1)[1] for name in kept_versions(warehouse, table)]
        lists = lists.filter(~F.regexp_extract("folder", "([^/]*)$", 1).isin(present))
    else:
        # Partitions that were packed have left their first folder.
        lists = stored_folders(warehouse, place).filter(F.col("folder").rlike("/[^/=]+=[^/]*$"))
    stored = stored.union(lists).filter(F.col("newest") < F.lit(before))
    return stored.join(shown_folders(warehouse, table), "shown_as", "left_anti")


def remove_folders(warehouse: Warehouse, table: str, folders: list[str]) -> None:
    """Remove folders with all they hold.

    A catalog deletes the files of a partition it drops if the table is its own, so the folders
    become partitions of a table that lives only for that.
    """
    sql, name = warehouse.spark.sql, warehouse.name(f"{table}_gone_{uuid.uuid4().hex[:12]}")
    sql(f"CREATE TABLE {name} (nothing int, n int) USING parquet PARTITIONED BY (n)")
    try:
        quoted = [folder.replace("\\", "\\\\").replace("'", "\\'") for folder in folders]
        sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION (n = {n}) LOCATION '{folder}'" for n, folder in enumerate(quoted)))
        sql(f"ALTER TABLE {name} DROP " + ", ".join(f"PARTITION (n = {n})" for n in range(len(folders))))
    finally:
        sql(f"DROP TABLE {name}")


def clean(warehouse: Warehouse, table: str, before: datetime, at_once: int = 1000) -> Removed:
    """Remove the unreachable folders of a table, oldest first, up to ``at_once`` in a run.

    Times are UTC if they carry no zone. A run that fails halfway has removed some; the next goes on.
    """
    chosen = unreachable(warehouse, table, before).orderBy("newest", "folder").limit(at_once).collect()
    if chosen:
        remove_folders(warehouse, table, [r.folder for r in chosen])
    return Removed(len(chosen), sum(r.files for r in chosen), sum(r.bytes for r in chosen))
