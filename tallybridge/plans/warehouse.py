"""Schemas, tables and the reporting view."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import suppress
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timestamps import load_moment
from ..operators.dimensions import new_calendar_days
from ..sources.calendar import day_range

# One table per target: two jobs that append to one folder at a time would disturb each other.
REJECTED = T.StructType([*schemas.RAW.fields[:3], T.StructField("reject_reason", T.StringType())])

# Table -> (data columns, partition columns, carries a load moment)
TABLES: dict[str, tuple[T.StructType, dict[str, str], bool]] = {
    "raw.kafka_events": (
        T.StructType([schemas.RAW["kafka_offset"], schemas.RAW["kafka_message"]]),
        {"kafka_topic": "string", "kafka_partition": "int", "route": "string", "offset_bucket": "bigint"},
        True,
    ),
    "raw.kafka_rejected": (REJECTED, {}, True),
    "raw.load_log": (schemas.RAW_LOADS, {}, True),
    "raw.load_runs": (schemas.LOAD_RUNS, {}, True),
    "raw.batch_stats": (schemas.BATCH_STATS, {}, True),
    "stg.transactions": (schemas.flagged(schemas.TRANSACTIONS), {"p_date": "date"}, True),
    "stg.currencies": (schemas.flagged(schemas.STG_CURRENCIES), {"p_date": "date"}, True),
    "stg.transactions_loads": (schemas.STAGED_LOADS, {}, True),
    "stg.currencies_loads": (schemas.STAGED_LOADS, {}, True),
    "stg.transactions_rejected": (REJECTED, {}, True),
    "stg.currencies_rejected": (REJECTED, {}, True),
    "stg.cursors": (T.StructType(schemas.CURSORS.fields[1:]), {"target": "string"}, True),
    "dds.transactions": (schemas.TRANSACTIONS, {"p_date": "date"}, True),
    "dds.currencies": (schemas.DDS_CURRENCIES, {"p_date": "date"}, True),
    "dds.dim_currency": (schemas.DIM_CURRENCY, {}, True),
    "dds.dim_calendar": (schemas.DIM_CALENDAR, {}, False),
    "dds.build_log": (schemas.BUILD_LOG, {}, True),
    "dds.build_loads": (schemas.SEEN_LOADS, {}, True),
    "cdm.global_metrics": (schemas.GLOBAL_METRICS, {"p_date": "date"}, False),
    "cdm.missing_rates": (schemas.MISSING_RATES, {"p_date": "date"}, False),
    "cdm.mart_bounds": (schemas.MART_BOUNDS, {"part": "string"}, False),
    "cdm.sender_bits": (schemas.SENDER_BITS, {"p_date": "date"}, False),
    "dds.dim_account": (schemas.DIM_ACCOUNT, {}, True),
    "dds.row_copies": (schemas.ROW_COPIES, {"p_date": "date"}, True),
    "dds.sender_rows": (schemas.SENDER_ROWS, {"p_date": "date"}, True),
    "dds.turnover_changes": (schemas.TURNOVER_CHANGES, {"p_date": "date"}, True),
    "dds.deltas": (schemas.DELTAS, {}, True),
    "dds.backfill_journal": (schemas.BACKFILL_JOURNAL, {}, True),
}

# Tables whose days are replaced. Each is a view over the version that holds now.
SWITCHED = {"dds.transactions", "dds.currencies", "cdm.global_metrics", "cdm.missing_rates", "cdm.sender_bits"}
FIRST_VERSION = "first"
# What the catalog lists for a partition of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

COLUMNS = """
SELECT c.date AS date_update, c.year, c.quarter, c.month,
       u.currency_code AS currency_from, u.currency_iso_code, u.country,
       coalesce(m.amount_total, CAST(0 AS DECIMAL(18,2))) AS amount_total,
       coalesce(m.cnt_transactions, 0L) AS cnt_transactions,
       coalesce(m.avg_transactions_per_account, 0.0D) AS avg_transactions_per_account,
       coalesce(m.cnt_accounts_make_transactions, 0L) AS cnt_accounts_make_transactions
"""
# The days of the mart come from a row that a build leaves beside it, so reading the view reads no mart for them.
VIEW = """
CREATE VIEW IF NOT EXISTS {cdm}.v_global_metrics AS
WITH unfolded AS (
    SELECT currency_code, currency_iso_code, country,
           explode(sequence((SELECT min(first_day) FROM {cdm}.mart_bounds), (SELECT max(last_day) FROM {cdm}.mart_bounds))) AS date
    FROM {dds}.dim_currency
)""" + COLUMNS + """
FROM unfolded u
JOIN {dds}.dim_calendar c ON c.date = u.date
LEFT JOIN {cdm}.global_metrics m ON m.date_update = u.date AND m.currency_from = u.currency_code
"""

# The same for a dashboard's filters: only the days asked for are unfolded, and only their partitions read.
BETWEEN = """
CREATE FUNCTION IF NOT EXISTS {cdm}.global_metrics_between(first_day DATE, last_day DATE, currencies ARRAY<INT>)
RETURNS TABLE (
    date_update DATE, year INT, quarter INT, month INT, currency_from INT, currency_iso_code STRING, country STRING,
    amount_total DECIMAL(18,2), cnt_transactions BIGINT, avg_transactions_per_account DOUBLE, cnt_accounts_make_transactions BIGINT)
RETURN
WITH unfolded AS (
    SELECT currency_code, currency_iso_code, country,
           explode(sequence(global_metrics_between.first_day,
                            greatest(global_metrics_between.first_day, global_metrics_between.last_day))) AS date
    FROM {dds}.dim_currency
    WHERE global_metrics_between.currencies IS NULL OR array_contains(global_metrics_between.currencies, currency_code)
), kept AS (
    SELECT * FROM {cdm}.global_metrics
    WHERE p_date BETWEEN global_metrics_between.first_day AND global_metrics_between.last_day
)""" + COLUMNS + """
FROM unfolded u
JOIN {dds}.dim_calendar c ON c.date = u.date AND c.date BETWEEN global_metrics_between.first_day AND global_metrics_between.last_day
LEFT JOIN kept m ON m.date_update = u.date AND m.currency_from = u.currency_code
WHERE u.date BETWEEN (SELECT min(first_day) FROM {cdm}.mart_bounds) AND (SELECT max(last_day) FROM {cdm}.mart_bounds)
"""


@dataclass(frozen=True)
class Warehouse:
    """Names and places of the tables. ``prefix`` keeps several warehouses apart in one catalog.

    Tables are external: moving a partition's pointer or dropping it never deletes files
    that a running reader may still need.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def location(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def partitions(self, table: str) -> list[str]:
        """Partitions the catalog holds, as ``column=value``; no data is read."""
        return [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.held(table)}").collect()]

    def values_of(self, table: str, partition: str) -> tuple:
        """The values of a partition by the name the catalog lists it under, in the types of its columns."""
        kinds = TABLES[table][1]
        read = {"int": int, "bigint": int, "date": date.fromisoformat}
        named = (part.split("=", 1) for part in partition.split("/"))
        return tuple(None if v == NO_VALUE else read.get(kinds[c], str)(unquote(v)) for c, v in named)

    def held(self, table: str) -> str:
        """The catalog's table behind a name: the version that its view shows, if it has versions."""
        if table not in SWITCHED:
            return self.name(table)
        told = {row[0]: row[1] for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()}
        if "View Text" not in told:
            raise RuntimeError(f"{self.name(table)} is a table of an earlier layout; it has to become a view over a version")
        return told["View Text"].split()[-1]

    def days(self, table: str) -> set[date]:
        """Days that have a partition. Tables only get one together with rows."""
        found = set()
        for part in self.partitions(table):
            with suppress(ValueError):  # no day, or one that no calendar here has
                found.add(date.fromisoformat(part.removeprefix("p_date=")))
        return found

    def fresh_location(self, table: str) -> str:
        """A folder beside the table that no other run writes to."""
        return f"{self.location(table)}__runs/{uuid.uuid4().hex}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def columns(self, table: str) -> list[str]:
        """Stored order: data columns, load moment, partition columns."""
        data, partitions, stamped = TABLES[table]
        return [*data.fieldNames(), *(["load_dttm"] if stamped else []), *partitions]

    def create(self) -> "Warehouse":
        """Schemas, tables and view, each only if absent."""
        for layer in ("raw", "stg", "dds", "cdm"):
            place = f"{self.root.rstrip('/')}/{layer}"
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer} LOCATION '{place}'")
        for table, (data, partitions, stamped) in TABLES.items():
            fields = [f"{f.name} {f.dataType.simpleString()}" for f in data.fields]
            fields += ["load_dttm timestamp"] if stamped else []
            fields += [f"{name} {kind}" for name, kind in partitions.items()]
            split = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            name, place = self.name(table), self.location(table)
            if table in SWITCHED:
                name, place = f"{name}__{FIRST_VERSION}", f"{place}__{FIRST_VERSION}"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(fields)}) USING parquet {split} LOCATION '{place}'")
            if table in SWITCHED:
                self.spark.sql(f"CREATE VIEW IF NOT EXISTS {self.name(table)} AS SELECT * FROM {name}")
        for text in (VIEW, BETWEEN):
            self.spark.sql(text.format(dds=f"{self.prefix}dds", cdm=f"{self.prefix}cdm"))
        return self

    def metrics_between(self, first: date, last: date, currencies: Sequence[int] | None = None) -> DataFrame:
        """The gap-filled view for a dashboard's days and currencies, through the SQL function of that name.

        SQL calls a table function without its schema, so the schema is the current one for the call.
        """
        catalog, chosen = self.spark.catalog, list(currencies) if currencies else None
        before = catalog.currentDatabase()
        catalog.setCurrentDatabase(f"{self.prefix}cdm")
        try:
            listed = "CAST(NULL AS ARRAY<INT>)" if chosen is None else f"array({', '.join(str(int(c)) for c in chosen)})"
            return self.spark.sql(f"SELECT * FROM global_metrics_between(:first, :last, {listed})", args={"first": first, "last": last})
        finally:
            catalog.setCurrentDatabase(before)

    def drop(self) -> None:
        """Forget the tables; files stay."""
        for layer in ("cdm", "dds", "stg", "raw"):
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.prefix}{layer} CASCADE")

    def append(self, table: str, df: DataFrame) -> None:
        """Append by column name; the load moment is added last, after any DISTINCT.

        Rows that come typed, without the flag of the parser, count as complete.
        """
        if "had_missing" in TABLES[table][0].fieldNames() and "had_missing" not in df.columns:
            df = df.withColumn("had_missing", F.lit(False))
        if TABLES[table][2] and "load_dttm" not in df.columns:
            df = df.withColumn("load_dttm", load_moment())
        df.select(*self.columns(table)).write.mode("append").insertInto(self.name(table))

    def fill_calendar(self, first: str = schemas.CALENDAR_FROM, last: str = schemas.CALENDAR_TO) -> None:
        """Add the days of the range the calendar does not hold yet."""
        days = day_range(self.spark, first, last)
        self.append("dds.dim_calendar", new_calendar_days(days, self.table("dds.dim_calendar")))
