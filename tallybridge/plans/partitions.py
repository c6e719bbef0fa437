"""Replacing days: load a shadow, then switch to a version that shows it.

The new content of all requested days is written to a shadow table with a folder of its
own, in one job. Only when that has succeeded does a new version list all days, the new ones and those
that stay, and one change of a view makes it the table: a reader sees all of a range as it was or all
of it as it is. A failed or repeated run leaves the table as it was, readers keep the files they
started with, and a table can be rebuilt from itself.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import load_moment
from .warehouse import FIRST_VERSION, NO_VALUE, TABLES, Warehouse

PLACES = "p_date string, place string"
# Versions of a table that the catalog keeps, the present one included.
KEPT_VERSIONS = 3

# Sorting inside each file lets row groups be skipped by the leading key.
SORT_KEYS = {
    "dds.transactions": ["transaction_dt", "operation_id"],
    "dds.currencies": ["currency_from", "currency_to"],
    "cdm.global_metrics": ["date_update", "currency_from"],
    "cdm.missing_rates": ["process_date", "currency_from"],
    "cdm.sender_bits": ["date_update", "currency_from", "bucket"],
    "stg.transactions": ["transaction_dt", "operation_id"],
    "stg.currencies": ["date_update", "currency_code"],
}


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def partition_id(day: date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


def laid_out_by_day(df: DataFrame, table: str) -> DataFrame:
    """Rows collected by day into files of AQE's advisory size, sorted by the table's keys.

    A day that is larger than that is split, so a hot day is never one task, and small
    days are not spread over as many files as there are tasks; one day or many make no difference.
    """
    return df.hint("rebalance", "p_date").sortWithinPartitions("p_date", *SORT_KEYS[table])


def load_shadow(warehouse: Warehouse, table: str, df: DataFrame, days: Sequence[date]) -> tuple[str, set[date]]:
    """Write the requested days to a fresh shadow table; its folder and the days that hold rows.

    The catalog learns the days from the write, so nothing is read back.
    """
    if TABLES[table][2]:
        df = df.withColumn("load_dttm", load_moment())
    wanted = F.col("p_date").between(F.lit(min(days)), F.lit(max(days)))
    if len(set(days)) < (max(days) - min(days)).days + 1:
        wanted = wanted & F.col("p_date").isin(*days)
    df = df.filter(wanted).select(*warehouse.columns(table))

    folder = warehouse.fresh_location(table)
    shadow = f"{table}_shadow_{folder.rsplit('/', 1)[1]}"
    sql, name = warehouse.spark.sql, warehouse.name(shadow)
    sql(f"CREATE TABLE {name} LIKE {warehouse.held(table)} USING parquet LOCATION '{folder}'")
    try:
        laid_out_by_day(df, table).write.insertInto(name)
        return folder, warehouse.days(shadow)
    finally:
        sql(f"DROP TABLE {name}")  # external: the files stay


def point_partitions(warehouse: Warehouse, table: str, places: dict[str, str]) -> None:
    """Let partitions, named as the catalog lists them, read from new folders: one catalog update each."""
    name, sql = warehouse.name(table), warehouse.spark.sql
    present = set(warehouse.partitions(table))
    clauses = {part: _clause(part) for part in places}
    added = [f"{clauses[part]} LOCATION '{place}'" for part, place in places.items() if part not in present]
    if added:
        sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added)}")
    for part, place in places.items():
        if part in present:
            sql(f"ALTER TABLE {name} {clauses[part]} SET LOCATION '{place}'")


def _clause(partition: str) -> str:
    """``column=value/column=value`` as SQL says it."""
    pairs = (part.split("=", 1) for part in partition.split("/"))
    told = []
    for column, value in pairs:
        plain = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        told.append(f"{column} = " + ("NULL" if value == NO_VALUE else f"'{plain}'"))
    return f"PARTITION ({', '.join(told)})"


def replace_days(warehouse: Warehouse, table: str, df: DataFrame, days: Sequence[date]) -> set[date]:
    """Make ``df`` the whole content of ``days``, all at once, and return the days that hold rows.

    A requested day without rows in ``df`` ends up empty. Other days are not touched. A table's
    days are replaced by one run at a time.
    """
    if not days:
        return set()
    folder, filled = load_shadow(warehouse, table, df, days)
    kept = {day: place for day, place in places(warehouse, table).items() if day not in {str(d) for d in days}}
    switch(warehouse, table, kept | {str(day): f"{folder}/p_date={day}" for day in filled})
    return filled


def places(warehouse: Warehouse, table: str) -> dict[str, str]:
    """Where the days of a table's version are, as its list says."""
    version = warehouse.held(table).rsplit("__", 1)[1]
    if version == FIRST_VERSION:
        return {}
    return dict(tuple(r) for r in warehouse.spark.read.schema(PLACES).parquet(_list_of(warehouse, table, version)).collect())


def _list_of(warehouse: Warehouse, table: str, version: str) -> str:
    return f"{warehouse.location(table)}__versions/{version}"


def switch(warehouse: Warehouse, table: str, days: dict[str, str]) -> None:
    """Let a table consist of the given days, each in its folder, from one moment on.

    The version is a catalog table of its own with its days in one statement and their list
    beside it; nobody sees it until the view changes. The last versions stay for readers that
    have planned with them; the files of dropped ones stay too.
    """
    name, old, sql = warehouse.name(table), warehouse.held(table), warehouse.spark.sql
    version = f"{time.time_ns():020d}{uuid.uuid4().hex[:6]}"
    new = f"{name}__{version}"
    sql(f"CREATE TABLE {new} LIKE {old} USING parquet LOCATION '{warehouse.location(table)}__none'")
    if days:
        parts = " ".join(f"PARTITION (p_date = '{day}') LOCATION '{place}'" for day, place in sorted(days.items()))
        sql(f"ALTER TABLE {new} ADD {parts}")
    listed = warehouse.spark.createDataFrame(sorted(days.items()), PLACES)
    listed.coalesce(1).write.parquet(_list_of(warehouse, table, version))
    sql(f"ALTER VIEW {name} AS SELECT * FROM {new}")
    for past in kept_versions(warehouse, table)[:-KEPT_VERSIONS]:
        sql(f"DROP TABLE IF EXISTS {past}")  # external: the files stay until they are cleaned


def kept_versions(warehouse: Warehouse, table: str) -> list[str]:
    """The versions of a table that the catalog holds, oldest first; the empty first one counts only while it is shown."""
    schema, short = warehouse.name(table).split(".")
    found = warehouse.spark.sql(f"SHOW TABLES IN {schema} LIKE '{short}__0*'").collect()
    return [f"{schema}.{name}" for name in sorted(r.tableName for r in found)] or [warehouse.held(table)]
