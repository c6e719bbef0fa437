"""Batch ingest: records -> RAW -> STG."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..functions.days import with_day
from ..functions.timestamps import load_moment
from ..operators import cursors as C
from ..operators import intervals as I
from ..operators import raw as R
from ..operators import staging as S
from ..schemas import (
    BATCH_STATS,
    BEGUN,
    COORDINATES,
    CURRENCY,
    LANDED,
    RAW_LOADS,
    STAGED_LOADS,
    STAGING_BATCH,
    TRANSACTION,
)
from ..sources.coordinates import RANGE, OffsetRange, as_frame, offset_bucket, scan_ranges
from .concurrent import side_by_side
from .partitions import laid_out_by_day, point_partitions
from .warehouse import Warehouse

RAW_LAYOUT = ["kafka_topic", "kafka_partition", "route", "offset_bucket"]
TARGET_TABLES = {TRANSACTION: "stg.transactions", CURRENCY: "stg.currencies"}
DAY_SOURCES = {TRANSACTION: "transaction_dt", CURRENCY: "date_update"}
PARTITION = COORDINATES[:2]


@dataclass(frozen=True)
class BatchStats:
    """Records of a batch. Unreadable ones have no value and are kept by their coordinates;
    what is neither saved nor unreadable was stored before or repeated."""

    received: int
    saved: int
    unreadable: int = 0

    @property
    def duplicates(self) -> int:
        return self.received - self.saved - self.unreadable


def land_batch(warehouse: Warehouse, batch: DataFrame) -> BatchStats:
    """Append the records of ``batch`` that RAW does not hold yet.

    A first pass makes a row per cell of 32,768 offsets and combines in every task, so no
    coordinate is shuffled; only the offsets of cells with holes are looked at one by one. Each span
    without holes is held against the ranges that RAW holds: what lies inside one is known and not read
    again, what meets none is new and moves once, into the table's layout. That rebalance gives each
    directory files of AQE's advisory size and splits a stream partition with most of the rows over
    several tasks. Only offsets of spans that a range cuts are looked up, in the ranges; RAW itself is read where an interrupted landing has left a
    claim. Records without a value go to ``raw.kafka_rejected``. The same function serves as the
    body of a ``foreachBatch`` sink; source offsets are committed by whoever calls it, after it returns.
    """
    return _land(warehouse, batch)[0]


def _noted(warehouse: Warehouse, found: DataFrame) -> DataFrame:
    """Cells or spans, written once: all that follows is about what this pass saw."""
    folder = warehouse.fresh_location("raw.cells")
    found.write.parquet(folder)
    return warehouse.spark.read.schema(found.schema).parquet(folder)


def stored_ranges(warehouse: Warehouse) -> DataFrame:
    """The offsets that RAW holds with a value, as disjoint ranges, from the log of landings."""
    return I.islands(_logged(warehouse))


def _logged(warehouse: Warehouse) -> DataFrame:
    """The ranges as landings logged them; where a landing was repeated or met others, they overlap or touch."""
    held = warehouse.table("raw.load_runs")
    return held.select(*PARTITION, F.col("first_offset").alias("first"), F.col("last_offset").alias("last"))


def _within(logged: DataFrame, ranges: list[Row]) -> DataFrame:
    """What the ranges ``logged`` hold between the bounds of the batch, a row per stream partition."""
    bounds = as_frame(logged, [OffsetRange(r.kafka_topic, r.kafka_partition, r.first, r.last) for r in ranges])
    bounds = bounds.select(*PARTITION, F.col("first").alias("low"), F.col("last").alias("high"))
    near = logged.join(F.broadcast(bounds), PARTITION).filter("first <= high AND last >= low")
    return near.select(*PARTITION, F.greatest("first", "low").alias("first"), F.least("last", "high").alias("last"))


def recount_ranges(warehouse: Warehouse) -> None:
    """Log the ranges of all that RAW holds, for a RAW that was filled or changed by other means."""
    raw = warehouse.table("raw.kafka_events")
    _log_runs(warehouse, uuid.uuid4().hex, I.runs(I.cells(raw), raw))


def _log_runs(warehouse: Warehouse, load_id: str, ranges: DataFrame) -> None:
    named = ranges.select(F.lit(load_id).alias("load_id"), *PARTITION, F.col("first").alias("first_offset"), F.col("last").alias("last_offset"))
    warehouse.append("raw.load_runs", named)


def _log_loads(warehouse: Warehouse, load_id: str, ranges: list[Row], state: str) -> None:
    rows = [(load_id, r.kafka_topic, r.kafka_partition, r.first, r.last, r.received, state) for r in ranges]
    frame = warehouse.spark.createDataFrame(rows, RAW_LOADS)
    warehouse.append("raw.load_log", frame.coalesce(1))


def _claims(warehouse: Warehouse) -> DataFrame:
    """Ranges of landings that began and did not end: RAW may hold some of their records."""
    log = warehouse.table("raw.load_log")
    ended = log.filter(F.col("state") == LANDED).select("load_id").distinct()
    begun = log.filter(F.col("state") == BEGUN).join(ended, "load_id", "left_anti")
    return begun.select(*PARTITION, F.col("first_offset").alias("first"), F.col("last_offset").alias("last"))


def _land(warehouse: Warehouse, batch: DataFrame) -> tuple[BatchStats, list[Row]]:
    """What became of the batch, and per stream partition the offsets it offered."""
    found = _noted(warehouse, I.cells_of(I.blocks(batch)))
    totals = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("received").alias("received")]
    # One row per stream partition, of which a broker has a bounded number.
    ranges = sorted(found.groupBy(*PARTITION).agg(*totals, F.count_if(I.is_torn()).alias("torn")).collect())
    if not ranges:
        return BatchStats(0, 0), []
    load_id = uuid.uuid4().hex
    received = sum(r.received for r in ranges)
    # A claim is logged before any row is written, so what an interrupted landing left is looked up.
    known, claimed = _within(_logged(warehouse), ranges), _within(_claims(warehouse), ranges)
    told = _noted(warehouse, I.judged(I.spans(found, batch if any(r.torn for r in ranges) else None), known, claimed))
    counts = [F.sum("received").alias("received"), F.sum(F.col("last") - F.col("first") + 1).alias("offsets")]
    by_status = {r.status: r for r in told.groupBy("status").agg(*counts).collect()}
    by_status.pop(I.KNOWN, None)
    new, rows, log_runs, found_again = 0, 0, None, []
    if by_status:
        _log_loads(warehouse, load_id, ranges, BEGUN)
        copies = any(r.received > r.offsets for r in by_status.values())
        wanted = told.filter(F.col("status") == I.NEW).select(*I.SPAN)
        if I.MIXED in by_status:
            unheld, found_again = _looked_up(warehouse, told.filter(F.col("status") == I.MIXED), known, claimed)
            wanted = _noted(warehouse, wanted.unionByName(unheld.select(*I.SPAN)))
        # Records that arrived after the spans were taken belong to the next batch.
        size = I.size_of(wanted)
        new, part = size.offsets, I.rows_in(batch, wanted, size)
    if new:
        laid_out = (
            R.new_records(part, copies=copies)
            .withColumns({"route": R.route(), "offset_bucket": offset_bucket()})
            .hint("rebalance", *RAW_LAYOUT)
            .sortWithinPartitions(*RAW_LAYOUT, "kafka_offset")
        )
        # Observed last: further down, AQE drops the counter with a stage that turned out empty.
        saved = Observation()
        warehouse.append("raw.kafka_events", laid_out.observe(saved, F.count(F.lit(1)).alias("rows")))
        rows = (_observed(saved) or {"rows": 0})["rows"]
    gained = list(found_again)
    if rows:  # those without a value are not held
        gained.append(wanted if rows == new else I.ranges_of(I.blocks(R.readable(part))))
    if gained:
        log_runs = partial(_log_runs, warehouse, load_id, I.islands(reduce(DataFrame.unionByName, [g.select(*I.SPAN) for g in gained])))
    stats = BatchStats(received, rows, new - rows)
    totals = [(load_id, stats.received, stats.saved, stats.duplicates, stats.unreadable)]
    log_stats = partial(warehouse.append, "raw.batch_stats", warehouse.spark.createDataFrame(totals, BATCH_STATS).coalesce(1))
    side_by_side(warehouse.spark, log_stats, *([log_runs] if log_runs else []))
    if stats.unreadable:
        held = [R.readable(part)] if copies else []
        rejected = I.rows_in(warehouse.table("raw.kafka_rejected"), wanted, size)
        warehouse.append("raw.kafka_rejected", R.new_unreadable(part, *held, rejected).withColumn("reject_reason", F.lit("no value")))
    _log_loads(warehouse, load_id, ranges, LANDED)
    return stats, ranges


def _looked_up(warehouse: Warehouse, mixed: DataFrame, known: DataFrame, claimed: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """What RAW does not hold of the spans ``mixed``, and ranges that it does hold but no landing has logged.

    The first is told from the logged ranges and, where claims are open, from RAW's rows.
    """
    keys = [*PARTITION, "cell"]
    held = I.masks(I.in_cells(known).join(mixed.select(*keys).distinct(), keys, "left_semi"))
    left = [OffsetRange(*r) for r in I.islands(claimed).select(*RANGE.fieldNames()).collect()]
    unlogged = []
    if left:
        rows = scan_ranges(warehouse.table("raw.kafka_events"), left).select(*COORDINATES)
        met = I.blocks(I.rows_in(rows, mixed, I.size_of(mixed))).select(*PARTITION, "block", "mask")
        unlogged = [_noted(warehouse, I.ranges_of(I.without(met, held)))]
        held = held.unionByName(met)
    return I.ranges_of(I.without(I.masks(mixed), held)), unlogged


@dataclass(frozen=True)
class ReplayedPartition:
    topic: str
    partition: int
    stored: int | None
    earliest: int
    latest: int


def replay(warehouse: Warehouse, batch: DataFrame) -> tuple[BatchStats, list[ReplayedPartition]]:
    """Land everything the source still holds, from its earliest offset on.

    Reports, per stream partition, how far RAW reached before and what the source offered.
    """
    marks = stored_watermarks(warehouse).collect()
    stored = {(m.kafka_topic, m.kafka_partition): m.high_watermark for m in marks}
    stats, ranges = _land(warehouse, batch)
    figures = [
        ReplayedPartition(r.kafka_topic, r.kafka_partition, stored.get((r.kafka_topic, r.kafka_partition)), r.first, r.last)
        for r in ranges
    ]
    return stats, figures


def _offsets(warehouse: Warehouse, state: str) -> DataFrame:
    """Highest offset per stream partition that landings of this state reached."""
    return (
        warehouse.table("raw.load_log").filter(F.col("state") == state)
        .groupBy(*PARTITION).agg(F.max("last_offset").alias("high_watermark"))
    )


def stored_watermarks(warehouse: Warehouse) -> DataFrame:
    """Highest offset landed per stream partition, from the log of landings.

    The cost of a window therefore does not depend on how much is stored or still unread.
    """
    return _offsets(warehouse, LANDED)


def store_cursors(warehouse: Warehouse, target: str, cursors: dict[tuple[str, int], int]) -> None:
    """Replace a target's cursors: a small file written aside, then one pointer update.

    Each target has a partition of its own, so targets advance independently.
    """
    rows = [(topic, partition, offset) for (topic, partition), offset in cursors.items()]
    frame = warehouse.spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, offset_to bigint")
    folder = warehouse.fresh_location("stg.cursors")
    frame.withColumn("load_dttm", load_moment()).coalesce(1).write.parquet(folder)
    point_partitions(warehouse, "stg.cursors", {f"target={target}": folder})


def _observed(figures: Observation) -> dict | None:
    """What was counted, or None where AQE dropped the counter with rows that turned out to be none."""
    try:
        return figures.get
    except Py4JJavaError:
        return None


def append_staged(warehouse: Warehouse, table: str, rows: DataFrame) -> list[date]:
    """Append rows with their ``p_date`` to a staging table, then log the load and its days.

    The log entry is written after the rows are committed. A build notes the entries it can
    see before it reads, so rows committed later are late for it however early they were
    planned. Returns the days, which are as many as the rows have.
    """
    load_id, seen = uuid.uuid4().hex, Observation()
    laid_out = laid_out_by_day(rows, table)
    warehouse.append(table, laid_out.observe(seen, F.collect_set("p_date").alias("days")))
    days = sorted((_observed(seen) or {}).get("days") or [])
    if days:
        entries = warehouse.spark.createDataFrame([(table, load_id, d) for d in days], STAGED_LOADS)
        warehouse.append(f"{table}_loads", entries.coalesce(1))
    return days


def stage_batch(warehouse: Warehouse, raw: DataFrame, object_type: str, mode: str = "quarantine") -> None:
    """Parse RAW rows into the target's staging table and set its rejects aside.

    Messages are parsed once; only a batch that had rejects is read again for them. Also
    the body of a ``foreachBatch`` sink over a stream of RAW rows.
    """
    target = TARGET_TABLES[object_type]
    parsed = S.PARSERS[object_type](raw)
    broken = Observation()
    counted = parsed.observe(broken, F.count_if(F.col("reject_reason").isNotNull()).alias("rows"))
    append_staged(warehouse, target, with_day(S.staged(counted, object_type, mode), DAY_SOURCES[object_type]))
    figures = _observed(broken)
    if figures is None or figures["rows"]:
        warehouse.append(f"{target}_rejected", S.rejected(parsed))


def staged_loads(warehouse: Warehouse) -> DataFrame:
    """The log of both targets."""
    logs = [warehouse.table(f"{table}_loads") for table in TARGET_TABLES.values()]
    return logs[0].unionByName(logs[1]).select("target", "load_id", "process_date")


def load_staging(
    warehouse: Warehouse, object_type: str, batch: int = STAGING_BATCH, mode: str = "quarantine"
) -> list[tuple]:
    """Load the next offset window of every stream partition into the target's table.

    Only directories that can hold messages of the type are read and parsed.
    Returns ``(topic, partition, offset_from, offset_to)`` of the windows that moved. The
    cursors are stored after the load: a crash in between repeats the window, and the
    copies fall to the DISTINCT of the next layer.
    """
    raw, target = warehouse.table("raw.kafka_events"), TARGET_TABLES[object_type]
    # One cursor per stream partition, of which a broker has a bounded number.
    cursors = C.current_cursors(warehouse.table("stg.cursors"), target).collect()
    known = warehouse.spark.createDataFrame(cursors, "kafka_topic string, kafka_partition int, cursor bigint")
    windows = C.next_windows(stored_watermarks(warehouse), known, batch).filter("advanced").collect()
    if not windows:
        return []
    unread_ranges = [OffsetRange(w.kafka_topic, w.kafka_partition, w.offset_from + 1, w.offset_to) for w in windows]
    stage_batch(warehouse, scan_ranges(R.readable_by(raw, object_type), unread_ranges), object_type, mode)
    store_cursors(warehouse, target, {(c[0], c[1]): c[2] for c in cursors} | {(w[0], w[1]): w.offset_to for w in windows})
    return [(w.kafka_topic, w.kafka_partition, w.offset_from, w.offset_to) for w in windows]


def catch_up(warehouse: Warehouse, batch: int = STAGING_BATCH, mode: str = "quarantine") -> dict[str, int]:
    """Load both targets until their cursors reach the watermarks; steps taken per target."""

    def run(object_type: str) -> int:
        steps = 0
        while load_staging(warehouse, object_type, batch, mode):
            steps += 1
        return steps

    targets = list(TARGET_TABLES)
    return dict(zip(targets, side_by_side(warehouse.spark, *[partial(run, t) for t in targets])))
