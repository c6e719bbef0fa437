"""Turnover that follows late and withdrawn rows without reading their days again.

Counts are kept as a log of changes, by day and, inside its files, by part. A batch reads the days that
its rows fall in, and of these the row groups that hold their parts. It appends its changes under an
id and commits the id last: what a failed batch wrote counts for nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import deltas as D
from ..schemas import BASE_CURRENCY, DELTAS
from .build import BUILT, DayStatus, publish_mart
from .concurrent import side_by_side
from .warehouse import Warehouse


@dataclass(frozen=True)
class Applied:
    """A batch of changes: its id, how many rows and senders it changed, and the days it touched."""

    delta_id: str
    rows: int
    senders: int
    days: list[date]


def _written(warehouse: Warehouse, df: DataFrame, label: str) -> DataFrame:
    folder = warehouse.fresh_location(label)
    df.write.parquet(folder)
    return warehouse.spark.read.schema(df.schema).parquet(folder)


def committed(warehouse: Warehouse, table: str) -> DataFrame:
    """The changes of committed batches; there is a row per batch on the other side."""
    ids = warehouse.table("dds.deltas").select("delta_id").distinct()
    return warehouse.table(table).join(ids, "delta_id", "left_semi")


def _touched(warehouse: Warehouse, table: str, changes: DataFrame) -> DataFrame:
    """The committed changes of the days and parts that ``changes`` falls in.

    The day is a filter on the partition column, the part one on the column that files are sorted by. What comes to the driver are days and, for each, at most BUCKETS numbers.
    """
    parts = changes.groupBy("p_date").agg(F.sort_array(F.collect_set("bucket")).alias("buckets")).collect()
    alike: dict[tuple[int, ...], list[date]] = {}
    for p in parts:
        alike.setdefault(tuple(p.buckets), []).append(p.p_date)
    held = committed(warehouse, table)
    if not alike:
        return held.filter("false")
    wanted = F.lit(False)
    for buckets, days in alike.items():
        wanted = wanted | (F.col("p_date").isin(*days) & F.col("bucket").isin(*buckets))
    return held.filter(wanted)


def apply_changes(warehouse: Warehouse, rows: DataFrame) -> Applied:
    """Add transactions, or withdraw those whose ``weight`` is negative; no ``weight`` adds each row once.

    Gives what a full rebuild over all rows added and not withdrawn would give. Batches are
    applied one at a time. One that fails can be applied again.
    """
    if "weight" not in rows.columns:
        rows = rows.withColumn("weight", F.lit(1))
    delta_id = uuid.uuid4().hex
    changes = _written(warehouse, D.row_changes(rows), "dds.changes")
    steps = _written(warehouse, D.row_steps(changes, _touched(warehouse, "dds.row_copies", changes)), "dds.changes")
    senders = _written(warehouse, D.sender_changes(steps), "dds.changes")
    moved = _written(warehouse, D.sender_steps(senders, _touched(warehouse, "dds.sender_rows", senders)), "dds.changes")
    named = lambda df: df.withColumn("delta_id", F.lit(delta_id))
    # Ranges of parts: a file holds neighbouring ones of a day, so its statistics tell what is in it.
    laid = lambda df: named(df).repartitionByRange("p_date", "bucket").sortWithinPartitions("p_date", "bucket")
    side_by_side(
        warehouse.spark,
        lambda: warehouse.append("dds.row_copies", laid(changes)),
        lambda: warehouse.append("dds.sender_rows", laid(senders)),
        lambda: warehouse.append("dds.turnover_changes", named(D.turnover_changes(moved)).coalesce(1)),
    )
    figures = steps.agg(F.count_if(F.col("step") != 0).alias("rows"), F.sort_array(F.collect_set("p_date")).alias("days")).first()
    count = moved.filter("step <> 0").count()
    log = warehouse.spark.createDataFrame([(delta_id, figures["rows"], count)], DELTAS)
    warehouse.append("dds.deltas", log.coalesce(1))
    return Applied(delta_id, figures["rows"], count, figures["days"])


def turnover(warehouse: Warehouse, days: Sequence[date] | None = None) -> DataFrame:
    """Turnover per day and currency as of the last committed batch; only its own small log is read."""
    changes = committed(warehouse, "dds.turnover_changes")
    return D.turnover(changes.filter(F.col("p_date").isin(*days)) if days is not None else changes)


def senders(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    """(date_update, currency_from, account_number_from) of all who have a completed transaction."""
    held = committed(warehouse, "dds.sender_rows").filter(F.col("p_date").isin(*days))
    found = held.groupBy(*D.SENDER).agg(F.sum("transactions").alias("n")).filter("n > 0")
    return found.select(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from"), "account_number_from")


def refresh_mart(warehouse: Warehouse, days: Sequence[date], base: int = BASE_CURRENCY) -> list[DayStatus]:
    """Bring the mart of ``days`` up to date from the counts and the rates of DDS; no transaction is read."""
    upstream = [DayStatus("dds", day, BUILT) for day in days]
    return publish_mart(warehouse, upstream, lambda built: _written(warehouse, turnover(warehouse, built), "cdm.turnover"), base)
