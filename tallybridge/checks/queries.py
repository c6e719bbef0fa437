"""Every operator as a query over the driver tables.

Queries that write use a warehouse or folder of their own under the shared folder; their
result is stored and the schemas are dropped again. Results leave with decimals as text and
timestamps without a zone, the forms the comparison reads alike from both engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.days import day_slice, partition_id
from ..functions.timestamps import parse_best_effort, to_millis
from ..operators import cleaning, cursors, dimensions, intervals, metrics, quality, raw, reports, staging
from ..plans import build, cleanup, clustering, compaction, incremental, ingest, users
from ..plans.concurrent import side_by_side
from ..plans.partitions import days_between, replace_days
from ..plans.warehouse import Warehouse
from ..schemas import COORDINATES, CURRENCY, LATEST_RATE, TRANSACTION
from ..session import fresh_dir, pin_utc
from ..sources import driver_tables as D
from ..sources.calendar import calendar
from ..sources.coordinates import RANGE, scan_ranges
from ..sources.records import file_stream, to_raw
from ..sources.tables import bound_scan
from ..streaming.raw_stream import land_files, start_raw
from ..streaming.staging_stream import raw_files, start_staging

# Slices take this part of the events' month; what came before the second half counts as delivered earlier.
SLICE_FIRST, SLICE_LAST = date(2024, 1, 5), date(2024, 1, 20)
# Spreads the driver's offsets over several buckets of RAW.
SPREAD = 40_000
SECOND_HALF = "2024-01-16"
# Offsets in runs of this many, each run in cells of its own; of three runs one is stored, one half of it, one not.
RUN, APART = 100, 40_000
WINDOW = 1000

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    forms = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        forms.append(column.alias(field.name))
    return df.select(*forms)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(pin_utc(spark), sf_dir))

        REGISTRY[name] = run
        return run

    return register


# ---- inputs -------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(D.records(spark, sf_dir))


def _landed_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(D.records(spark, sf_dir).filter(F.col("timestamp") < F.lit(SECOND_HALF).cast("timestamp")))


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record twice, those that landed earlier included."""
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    return to_raw(D.records(spark, sf_dir).withColumn("delivery", twice))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_transactions(D.staged_transactions(spark, sf_dir))


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_rates(D.staged_rates(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = D.event_days(spark, sf_dir)
    return metrics.global_metrics(_clean(spark, sf_dir), _rates(spark, sf_dir), days)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written once and read by every later step, as the layers below a report are."""
    folder = fresh_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored transactions, stored mart and the currency dimension over them."""
    clean = _stored(_clean(spark, sf_dir), "clean")
    mart = _stored(metrics.global_metrics(clean, _rates(spark, sf_dir), D.event_days(spark, sf_dir)), "mart")
    empty = spark.createDataFrame([], "currency_code int")
    return clean, mart, dimensions.new_currencies(clean, empty)


def _currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = spark.createDataFrame([], "currency_code int")
    return dimensions.new_currencies(_clean(spark, sf_dir), empty)


def _event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(D.event_days(spark, sf_dir, "date"))


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    prefix = f"tb_{uuid.uuid4().hex[:10]}_"
    return Warehouse(spark, fresh_dir(spark, label), prefix).create()


def _staged_warehouse(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    warehouse = _warehouse(spark, label)
    side_by_side(
        spark,
        lambda: ingest.append_staged(warehouse, "stg.transactions", D.staged_transactions(spark, sf_dir)),
        lambda: ingest.append_staged(warehouse, "stg.currencies", D.staged_rates(spark, sf_dir)),
    )
    return warehouse


def _finished(warehouse: Warehouse, result: DataFrame) -> DataFrame:
    """The result as files of its own; the warehouse's schemas are no longer needed."""
    kept = _stored(result, "result")
    warehouse.drop()
    return kept


def _event_bounds(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    return tuple(D.event_days(spark, sf_dir, "day").agg(F.min("day"), F.max("day")).first())


def _altered(spark: SparkSession, sf_dir: str, event_type: str, pattern: str, text: str) -> DataFrame:
    """RAW rows in which the messages of one type of event have a field replaced."""
    changed = F.when(
        F.contains("kafka_message", F.lit(f'"transaction_type":"{event_type}"')),
        F.regexp_replace("kafka_message", pattern, text),
    ).otherwise(F.col("kafka_message"))
    return _raw(spark, sf_dir).withColumn("kafka_message", changed)


# ---- RAW ----------------------------------------------------------------------


@query("raw_project")
def raw_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)


@query("raw_range_scan")
def raw_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored coordinates, several buckets of them, within the offset ranges of the second half's records."""
    records = D.records(spark, sf_dir).withColumn("offset", F.col("offset") * SPREAD)
    late = to_raw(records.filter(F.col("timestamp") >= F.lit(SECOND_HALF).cast("timestamp")))
    warehouse = _warehouse(spark, "range-scan")
    ingest.land_batch(warehouse, to_raw(records))
    found = scan_ranges(warehouse.table("raw.kafka_events"), raw.touched_ranges(late))
    return _finished(warehouse, found.select(*COORDINATES))


@query("raw_dedup")
def raw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.new_records(_redelivered(spark, sf_dir), _landed_earlier(spark, sf_dir))


@query("raw_batch_stats")
def raw_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.batch_counts(_redelivered(spark, sf_dir), _landed_earlier(spark, sf_dir))


def _record_files(spark: SparkSession, sf_dir: str) -> str:
    """The records as a folder a file stream can watch, every record in it twice."""
    folder = fresh_dir(spark, "records")
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    D.records(spark, sf_dir).withColumn("delivery", twice).drop("delivery").write.parquet(folder)
    return folder


def _streamed_raw(spark: SparkSession, sf_dir: str) -> str:
    folder = fresh_dir(spark, "raw-stream")
    records = file_stream(spark, _record_files(spark, sf_dir))
    start_raw(records, f"{folder}/files", f"{folder}/checkpoint", repeats=True, once=True).awaitTermination()
    return f"{folder}/files"


@query("raw_append")
def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming ingest of a source that repeats every record."""
    stored = spark.read.parquet(_streamed_raw(spark, sf_dir))
    return stored.select(
        *[F.col(c).cast("string" if c == "kafka_topic" else "bigint").alias(c) for c in COORDINATES], "kafka_message"
    )


@query("raw_land")
def raw_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ingest in two steps: the first half, then everything twice."""
    warehouse = _warehouse(spark, "raw-land")
    first = ingest.land_batch(warehouse, _landed_earlier(spark, sf_dir))
    second = ingest.land_batch(warehouse, _redelivered(spark, sf_dir))
    stored = _stored_per_partition(warehouse).select(
        "*",
        F.lit(first.saved).cast("bigint").alias("saved_first"),
        F.lit(second.saved).cast("bigint").alias("saved_second"),
        F.lit(second.duplicates).cast("bigint").alias("duplicates_second"),
    )
    return _finished(warehouse, stored)


@query("raw_unreadable")
def raw_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a value, here those of type ``signup``, are kept apart; landed twice."""
    warehouse = _warehouse(spark, "raw-unreadable")
    void = F.when(~F.contains("kafka_message", F.lit('"transaction_type":"signup"')), F.col("kafka_message"))
    batch = _raw(spark, sf_dir).withColumn("kafka_message", void)
    runs = [ingest.land_batch(warehouse, batch) for _ in range(2)]
    aside = warehouse.table("raw.kafka_rejected").groupBy(F.col("kafka_partition").cast("bigint").alias("kafka_partition")).agg(
        F.count(F.lit(1)).alias("rejected_rows"), F.sum("kafka_offset").alias("rejected_offsets")
    )
    totals = [
        F.lit(sum(getattr(r, name) for r in runs)).cast("bigint").alias(name) for name in ("received", "saved", "duplicates")
    ]
    return _finished(warehouse, _stored_per_partition(warehouse).join(aside, "kafka_partition", "left").select("*", *totals))


@query("raw_replay_noop")
def raw_replay_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full replay from the earliest offset saves nothing and reports what each partition holds."""
    warehouse = _warehouse(spark, "raw-replay")
    ingest.land_batch(warehouse, _raw(spark, sf_dir))
    replay, figures = ingest.replay(warehouse, _raw(spark, sf_dir))
    offered = spark.createDataFrame(
        [(f.partition, f.stored, f.earliest, f.latest) for f in figures],
        "kafka_partition bigint, stored_before bigint, earliest bigint, latest bigint",
    )
    stored = _stored_per_partition(warehouse).join(offered, "kafka_partition").select(
        "*",
        F.lit(replay.received).cast("bigint").alias("replay_received"),
        F.lit(replay.saved).cast("bigint").alias("replay_saved"),
    )
    return _finished(warehouse, stored)


def _in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rows with their offsets dealt out over cells."""
    place = F.expr(f"kafka_offset div {RUN} * {APART} + kafka_offset % {RUN}")
    return _raw(spark, sf_dir).withColumn("kafka_offset", place)


def _delivered(batch: DataFrame) -> DataFrame:
    """Every third run of offsets, and the first half of those that follow one."""
    run, place = F.expr(f"kafka_offset div {APART} % 3"), F.expr(f"kafka_offset % {APART}")
    return batch.filter((run == 0) | (run == 1) & (place < RUN // 2))


@query("raw_ranges")
def raw_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets that RAW holds after two landings, as disjoint ranges from the log."""
    warehouse = _warehouse(spark, "ranges")
    ingest.land_batch(warehouse, _landed_earlier(spark, sf_dir))
    ingest.land_batch(warehouse, _raw(spark, sf_dir).filter("kafka_offset % 50 < 40"))
    return _finished(warehouse, ingest.stored_ranges(warehouse))


@query("raw_holes")
def raw_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets between the first and the last that RAW does not hold, from the log."""
    warehouse = _warehouse(spark, "holes")
    ingest.land_batch(warehouse, _delivered(_in_runs(spark, sf_dir)))
    return _finished(warehouse, intervals.holes(ingest.stored_ranges(warehouse)))


@query("raw_cells")
def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a landing learns of each span of a batch of which a part is stored: known, new or to be looked up."""
    batch = _in_runs(spark, sf_dir)
    stored = _delivered(batch)
    known = intervals.runs(intervals.cells_of(intervals.blocks(stored)), stored)
    told = intervals.judged(intervals.spans(intervals.cells_of(intervals.blocks(batch)), batch), known, spark.createDataFrame([], RANGE))
    return told.select(*cursors.PARTITION, "cell", "first", "last", "received", "status")


@query("raw_gap_landing")
def raw_gap_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that lies in ranges, in gaps and across both lands on what is stored."""
    warehouse = _warehouse(spark, "gaps")
    batch = _in_runs(spark, sf_dir)
    first = ingest.land_batch(warehouse, _delivered(batch))
    second = ingest.land_batch(warehouse, batch.unionByName(batch.filter("kafka_offset % 7 = 0")))
    figures = {"saved_first": first.saved, "saved_second": second.saved, "duplicates_second": second.duplicates}
    return _finished(warehouse, _stored_per_partition(warehouse).select("*", *[F.lit(v).cast("bigint").alias(n) for n, v in figures.items()]))


@query("raw_stream_land")
def raw_stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without state writes every record twice; landing its files, and landing them again, stores each once."""
    warehouse, folder = _warehouse(spark, "stream-land"), fresh_dir(spark, "raw-files")
    records = file_stream(spark, _record_files(spark, sf_dir))
    start_raw(records, f"{folder}/files", f"{folder}/checkpoint", once=True).awaitTermination()
    runs = [land_files(warehouse, f"{folder}/files") for _ in range(2)]
    totals = [F.lit(sum(getattr(r, n) for r in runs)).cast("bigint").alias(n) for n in ("received", "saved", "duplicates")]
    return _finished(warehouse, _stored_per_partition(warehouse).select("*", *totals))


def _stored_per_partition(warehouse: Warehouse) -> DataFrame:
    return (
        warehouse.table("raw.kafka_events")
        .groupBy(F.col("kafka_partition").cast("bigint").alias("kafka_partition"))
        .agg(F.count(F.lit(1)).alias("stored_rows"), F.sum("kafka_offset").alias("offset_sum"))
    )


@query("raw_compacted")
def raw_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW landed in six batches, packed, and landed once more: a file per partition, the same rows, nothing new."""
    warehouse = _warehouse(spark, "packed")
    batch = _raw(spark, sf_dir)
    for part in range(6):
        ingest.land_batch(warehouse, batch.filter(F.col("kafka_offset") % 6 == part))
    compaction.compact(warehouse, "raw.kafka_events")
    again = ingest.land_batch(warehouse, batch)
    held = compaction.files(warehouse, "raw.kafka_events").groupBy(F.col("kafka_partition").cast("bigint").alias("kafka_partition")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("stored_rows")
    )
    return _finished(warehouse, held.withColumn("saved_again", F.lit(again.saved).cast("bigint")))


# ---- STG ----------------------------------------------------------------------


@query("route_by_type")
def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by destination; those of type ``error`` come with an object type nobody reads."""
    return staging.route_counts(_altered(spark, sf_dir, "error", '"object_type":"TRANSACTION"', '"object_type":"AUDIT"'))


@query("parse_transactions")
def parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = staging.parse_transactions(_raw(spark, sf_dir))
    return staging.staged(parsed, TRANSACTION)


@query("parse_currencies")
def parse_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.staged(staging.parse_rates(_raw(spark, sf_dir)), CURRENCY, mode="fail")


@query("parse_timestamps")
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's time in one of ten spellings, four of them unusable, read back."""
    moment = to_millis(F.col("ts").cast("timestamp"))
    spellings = [
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.concat(F.date_format(F.expr("ts + INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+03:00")),
        F.date_format(moment, "dd/MM/yyyy HH:mm:ss.SSS"),
        F.unix_millis(moment).cast("string"),
        F.date_format(moment, "yyyyMMddHHmmss"),
        F.concat(F.lit("on "), F.date_format(moment, "yyyy-MM-dd")),
        F.lit(""),
        F.lit("0000-01-01 00:00:00"),
        F.lit("9999-12-31T23:59:59-05:00"),
    ]
    text = F.get(F.array(*spellings), (F.col("event_id") % 10).cast("int"))
    return D.events(spark, sf_dir).select("event_id", parse_best_effort(text).alias("parsed"))


@query("quarantine")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose time is unreadable or in no year are set aside; here those of two types."""
    broken = _altered(spark, sf_dir, "error", '"transaction_dt":"[^"]*"', '"transaction_dt":"soon"')
    yearless = _altered(spark, sf_dir, "signup", '"transaction_dt":"[^"]*"', '"transaction_dt":"0000-01-01 00:00:00"')
    of = F.contains("kafka_message", F.lit('"transaction_type":"signup"'))
    return staging.rejected(staging.parse_transactions(broken.filter(~of).unionByName(yearless.filter(of))))


@query("staged_flagged")
def staged_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per currency and flag, where the messages of type ``signup`` hold a code that no integer holds."""
    odd = _altered(spark, sf_dir, "signup", '"currency_code":[0-9]+', '"currency_code":99999999999')
    warehouse = _warehouse(spark, "flagged")
    ingest.stage_batch(warehouse, odd, TRANSACTION)
    found = warehouse.table("stg.transactions").groupBy("currency_code", "had_missing").agg(F.count(F.lit(1)).alias("staged_rows"))
    return _finished(warehouse, found)


@query("staging_stream")
def staging_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records through both streams, RAW and STG, read back from the staging files."""
    stored = _streamed_raw(spark, sf_dir)
    folder = fresh_dir(spark, "staging-stream")
    start_staging(
        raw_files(spark, stored), TRANSACTION, f"{folder}/files", f"{folder}/checkpoint", once=True
    ).awaitTermination()
    files = spark.read.parquet(f"{folder}/files")
    return files.groupBy("currency_code", "status").agg(
        F.count(F.lit(1)).alias("staged_rows"),
        F.sum("amount").alias("amount_sum"),
        F.max("transaction_dt").alias("latest"),
    )


@query("staging_catch_up")
def staging_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW loaded into STG window by window until the cursors reach the watermarks."""
    warehouse = _warehouse(spark, "catch-up")
    ingest.land_batch(warehouse, _raw(spark, sf_dir))
    widest = warehouse.table("raw.kafka_events").agg(F.max("kafka_offset")).first()[0]
    ingest.catch_up(warehouse, batch=widest // 2 + 1)
    moved = warehouse.table("stg.transactions").groupBy("p_date").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("amount_sum")
    )
    quoted = warehouse.table("stg.currencies").groupBy("p_date").agg(F.count(F.lit(1)).alias("rates"))
    return _finished(warehouse, moved.join(quoted, "p_date", "full"))


# ---- incremental state ----------------------------------------------------------


@query("high_watermark")
def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the log of two landings."""
    warehouse = _warehouse(spark, "watermark")
    ingest.land_batch(warehouse, _landed_earlier(spark, sf_dir))
    ingest.land_batch(warehouse, _raw(spark, sf_dir))
    return _finished(warehouse, ingest.stored_watermarks(warehouse))


@query("top1_offset")
def top1_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cursors.top_offset(_raw(spark, sf_dir))


def _cursor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions were read up to the first half, in two entries; rates not at all."""
    earlier = cursors.high_watermarks(_landed_earlier(spark, sf_dir))
    entries = F.explode(F.array(F.expr("high_watermark div 2"), F.col("high_watermark")))
    return earlier.select(F.lit("stg.transactions").alias("target"), *cursors.PARTITION, entries.alias("offset_to"))


@query("offset_window")
def offset_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next window of each stream partition and the rows it holds."""
    stored = _raw(spark, sf_dir)
    known = cursors.current_cursors(_cursor_log(spark, sf_dir), "stg.transactions")
    windows = cursors.next_windows(cursors.high_watermarks(stored), known, WINDOW)
    held = scan_ranges(stored, cursors.as_ranges(windows)).groupBy(*cursors.PARTITION).agg(
        F.count(F.lit(1)).alias("rows_in_window")
    )
    return windows.join(held, cursors.PARTITION, "left").withColumn(
        "rows_in_window", F.coalesce("rows_in_window", F.lit(0).cast("bigint"))
    )


@query("offset_state_advance")
def offset_state_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors of both targets after one step each."""
    log, marks = _cursor_log(spark, sf_dir), cursors.high_watermarks(_raw(spark, sf_dir))
    steps = []
    for target in ("stg.transactions", "stg.currencies"):
        windows = cursors.next_windows(marks, cursors.current_cursors(log, target), WINDOW)
        grown = log.unionByName(cursors.advanced_cursors(windows, target))
        steps.append(cursors.current_cursors(grown, target).withColumn("target", F.lit(target)))
    return steps[0].unionByName(steps[1])


@query("stg_latest_dates")
def stg_latest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_days(D.staged_transactions(spark, sf_dir), D.staged_rates(spark, sf_dir))


@query("day_ready")
def day_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate that builds go through, over a staged warehouse."""
    warehouse = _staged_warehouse(spark, sf_dir, "gate")
    return _finished(warehouse, build.readiness(warehouse, days_between(*_event_bounds(spark, sf_dir))))


@query("late_days")
def late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are committed 0-119 minutes after their event, a load an hour, and planned an hour before;
    each day is built at 01:00 of the next and sees the loads of the hours before."""
    lag = F.make_interval(mins=(F.right("operation_id", F.lit(6)).cast("int") % 120))
    hour = F.date_trunc("HOUR", F.col("transaction_dt") + lag)
    loads = D.staged_transactions(spark, sf_dir).select(
        F.lit("stg.transactions").alias("target"),
        F.date_format(hour, "yyyy-MM-dd HH").alias("load_id"),
        F.col("p_date").alias("process_date"),
        hour.alias("committed"),
    )
    seen = loads.filter(F.col("committed") < F.expr("cast(date_add(process_date, 1) AS TIMESTAMP) + INTERVAL 1 HOUR"))
    return quality.late_days(loads, seen)


# ---- slices and partitions --------------------------------------------------------


@query("param_scan")
def param_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT operation_id, currency_code, status, amount, transaction_dt
        FROM {staged}
        WHERE transaction_dt >= CAST(:first AS TIMESTAMP)
          AND transaction_dt < CAST(date_add(:last, 1) AS TIMESTAMP)
    """
    return bound_scan(
        spark, text, {"first": SLICE_FIRST, "last": SLICE_LAST}, staged=D.staged_transactions(spark, sf_dir)
    )


@query("day_slice")
def day_slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = D.staged_transactions(spark, sf_dir)
    return day_slice(staged, "transaction_dt", SLICE_FIRST, SLICE_LAST).drop("p_date")


@query("day_partition_counts")
def day_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day directory, after writing the staging table."""
    warehouse = _staged_warehouse(spark, sf_dir, "day-partitions")
    moved = warehouse.table("stg.transactions").groupBy("p_date").agg(F.count(F.lit(1)).alias("transactions"))
    quoted = warehouse.table("stg.currencies").groupBy("p_date").agg(F.count(F.lit(1)).alias("rates"))
    return _finished(warehouse, moved.join(quoted, "p_date", "full"))


@query("partition_id")
def partition_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("transaction_dt")
    return (
        D.staged_transactions(spark, sf_dir)
        .groupBy(partition_id(day).alias("partition_id"))
        .agg(F.count(F.lit(1)).alias("staged_rows"))
    )


# ---- DDS ------------------------------------------------------------------------


@query("clean_transactions")
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@query("done_only")
def done_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.done_only(_clean(spark, sf_dir)).drop("p_date")


@query("rates_normalize")
def rates_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir)


@query("usd_rates")
def usd_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.base_rates(_rates(spark, sf_dir))


@query("rates_with_usd")
def rates_with_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rates_with_base(_rates(spark, sf_dir), D.event_days(spark, sf_dir))


@query("dim_currency_increment")
def dim_currency_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _currencies(spark, sf_dir)


@query("dim_currency_known")
def dim_currency_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that have rates count as known; what trades without rates is new."""
    known = _rates(spark, sf_dir).select(F.col("currency_from").alias("currency_code")).distinct()
    return dimensions.new_currencies(_clean(spark, sf_dir), known)


@query("dim_currency_conflicts")
def dim_currency_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.currency_conflicts(_currencies(spark, sf_dir))


@query("calendar_generate")
def calendar_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day between the first and the last order."""
    orders = spark.read.schema("o_orderdate timestamp_ntz").parquet(f"{sf_dir}/orders.parquet").select(
        F.to_date("o_orderdate").alias("day")
    )
    bounds = orders.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    return calendar(days)


@query("calendar_increment")
def calendar_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the event range that have no rate for the seventh currency yet."""
    held = _rates(spark, sf_dir).filter("currency_from = 470").select(F.col("rate_date").alias("date")).distinct()
    span = D.event_days(spark, sf_dir, "day").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    return dimensions.new_calendar_days(days, held)


# ---- CDM ------------------------------------------------------------------------


@query("transactions_agg")
def transactions_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.turnover(_clean(spark, sf_dir)).withColumn(
        "amount_in_currency", (F.col("minor_units").cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)"))
    ).drop("minor_units")


@query("global_metrics")
def global_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir)


@query("global_metrics_latest_rate")
def global_metrics_latest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart where of several rates of a day the last one counts."""
    rates = cleaning.normalize_rates(D.staged_rates(spark, sf_dir), LATEST_RATE)
    return metrics.global_metrics(_clean(spark, sf_dir), rates, D.event_days(spark, sf_dir))


@query("mart_date_bounds")
def mart_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.date_bounds(_mart(spark, sf_dir))


@query("calendar_x_currency")
def calendar_x_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mart, currencies = _layers(spark, sf_dir)
    return reports.calendar_by_currency(_event_calendar(spark, sf_dir), currencies, metrics.date_bounds(mart))


@query("gap_filled_view")
def gap_filled_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mart, currencies = _layers(spark, sf_dir)
    return reports.gap_filled(mart, _event_calendar(spark, sf_dir), currencies)


@query("dashboard_totals")
def dashboard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, mart, _ = _layers(spark, sf_dir)
    return reports.dashboard_totals(clean, mart)


@query("dashboard_by_currency")
def dashboard_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, mart, _ = _layers(spark, sf_dir)
    return reports.dashboard_totals(clean, mart, ["currency_from"])


@query("dashboard_slice")
def dashboard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mart, currencies = _layers(spark, sf_dir)
    view = reports.gap_filled(mart, _event_calendar(spark, sf_dir), currencies)
    return reports.dashboard_slice(view, SLICE_FIRST, SLICE_LAST, [420, 430, 460])


# ---- checks ---------------------------------------------------------------------


@query("missing_usd_rates")
def missing_usd_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_rates(_clean(spark, sf_dir), _rates(spark, sf_dir))


@query("ambiguous_rates")
def ambiguous_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ambiguous_rates(_rates(spark, sf_dir))


@query("day_exists")
def day_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event days and 15 more on either side, with and without data."""
    first, last = F.date_sub(F.min("day"), 15), F.date_add(F.max("day"), 15)
    span = D.event_days(spark, sf_dir, "day").agg(first.alias("first"), last.alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("process_date"))
    return quality.days_present(days, _clean(spark, sf_dir), _rates(spark, sf_dir))


@query("quality_report")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = D.event_days(spark, sf_dir, "process_date")
    return quality.quality_report(days, _clean(spark, sf_dir), _rates(spark, sf_dir))


# ---- whole builds -----------------------------------------------------------------


@query("backfill_range")
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after building every ready day from the staging tables."""
    warehouse = _staged_warehouse(spark, sf_dir, "backfill")
    build.backfill(warehouse, *_event_bounds(spark, sf_dir))
    return _finished(warehouse, warehouse.table("cdm.global_metrics").drop("p_date"))


@query("backfill_resumed")
def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal of a backfill in chunks of a week that stopped after two and was taken up again twice."""
    warehouse = _staged_warehouse(spark, sf_dir, "resumed")
    first, last = _event_bounds(spark, sf_dir)
    for most in (2, None, None):
        build.resume_backfill(warehouse, "all", first, last, chunk=7, most_chunks=most)
    mart = warehouse.table("cdm.global_metrics").groupBy(F.col("p_date").alias("process_date")).agg(F.count(F.lit(1)).alias("mart_rows"))
    journal = warehouse.table("dds.backfill_journal").groupBy("process_date", "layer", "status").agg(F.count(F.lit(1)).alias("times"))
    return _finished(warehouse, journal.join(mart, "process_date", "left"))


@query("backfill_missing_rates")
def backfill_missing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the builds of every ready day set aside for want of a rate."""
    warehouse = _staged_warehouse(spark, sf_dir, "unrated")
    build.backfill(warehouse, *_event_bounds(spark, sf_dir))
    return _finished(warehouse, warehouse.table("cdm.missing_rates").drop("p_date"))


@query("backfill_view")
def backfill_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reporting view over a built warehouse with the full calendar."""
    warehouse = _staged_warehouse(spark, sf_dir, "view")
    warehouse.fill_calendar()
    build.backfill(warehouse, *_event_bounds(spark, sf_dir))
    return _finished(warehouse, warehouse.table("cdm.v_global_metrics"))


def _changed_in_batches(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """Counts after three batches: the first half, the second, and the withdrawal of every seventh event.

    Of every event in twenty one of two copies is withdrawn too, which changes nothing.
    """
    warehouse = _warehouse(spark, label)
    staged = D.staged_transactions(spark, sf_dir)
    late, event = F.col("transaction_dt") >= F.lit(SECOND_HALF).cast("timestamp"), F.right("operation_id", F.lit(12)).cast("bigint")
    incremental.apply_changes(warehouse, staged.filter(~late))
    incremental.apply_changes(warehouse, staged.filter(late))
    gone, once = staged.filter(event % 7 == 0), staged.filter((event % 20 == 10) & (event % 7 != 0)).distinct()
    incremental.apply_changes(warehouse, gone.unionByName(once).withColumn("weight", F.lit(-1)))
    return warehouse


@query("incremental_turnover")
def incremental_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover kept by counted distinct rows and senders, after additions and withdrawals."""
    warehouse = _changed_in_batches(spark, sf_dir, "deltas")
    return _finished(warehouse, incremental.turnover(warehouse))


@query("incremental_mart")
def incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart brought up to date from the counts, without reading a transaction."""
    warehouse = _changed_in_batches(spark, sf_dir, "delta-mart")
    days = days_between(*_event_bounds(spark, sf_dir))
    replace_days(warehouse, "dds.currencies", _rates(spark, sf_dir).withColumn("p_date", F.col("rate_date")), days)
    incremental.refresh_mart(warehouse, days)
    return _finished(warehouse, warehouse.table("cdm.global_metrics").drop("p_date"))


def _with_bits(spark: SparkSession, sf_dir: str, label: str) -> tuple[Warehouse, date, date]:
    """A built warehouse with the bitmaps of its senders, numbered in two runs."""
    warehouse = _staged_warehouse(spark, sf_dir, label)
    first, last = _event_bounds(spark, sf_dir)
    built = build.backfill(warehouse, first, last)
    days = sorted({s.process_date for s in built if s.layer == "cdm" and s.status != build.SKIPPED})
    for part in (days[: len(days) // 2], days[len(days) // 2 :]):
        users.build_bits(warehouse, part)
    return warehouse, first, last


@query("users_by_currency")
def users_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard by currency over all built days, users from merged bitmaps."""
    warehouse, first, last = _with_bits(spark, sf_dir, "bits")
    return _finished(warehouse, users.dashboard(warehouse, first, last, by=["currency_from"]))


@query("users_of_slice")
def users_of_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for some days and currencies together."""
    warehouse, _, _ = _with_bits(spark, sf_dir, "bits-slice")
    return _finished(warehouse, users.dashboard(warehouse, SLICE_FIRST, SLICE_LAST, [420, 430, 460]))


@query("view_between")
def view_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap-filled view through its SQL table function, for some days and currencies."""
    warehouse = _staged_warehouse(spark, sf_dir, "between")
    warehouse.fill_calendar()
    build.backfill(warehouse, *_event_bounds(spark, sf_dir))
    return _finished(warehouse, warehouse.metrics_between(SLICE_FIRST, SLICE_LAST, [420, 430, 460]))


#: Later than any file here; in use, a moment before the oldest reader that is still running.
AFTER_ALL = datetime(9999, 1, 1)


def _replaced(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    """All days are loaded, then even days are replaced by their completed rows and tenth days emptied."""
    warehouse = _warehouse(spark, "replace")
    days = days_between(*_event_bounds(spark, sf_dir))
    replace_days(warehouse, "dds.transactions", _clean(spark, sf_dir), days)
    even = [d for d in days if d.day % 2 == 0]
    kept = cleaning.done_only(_clean(spark, sf_dir)).filter(F.dayofmonth("p_date") % 10 != 0)
    for _ in range(runs):
        replace_days(warehouse, "dds.transactions", kept, even)
    return _finished(warehouse, warehouse.table("dds.transactions").drop("load_dttm", "p_date"))


@query("clustered_days")
def clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, laid out anew by time, account and currency together: the same rows."""
    warehouse = _warehouse(spark, "clustered")
    days = days_between(*_event_bounds(spark, sf_dir))
    replace_days(warehouse, "dds.transactions", _clean(spark, sf_dir), days)
    clustering.cluster_days(warehouse, "dds.transactions", days, ["account_number_from", "transaction_dt", "currency_code"])
    return _finished(warehouse, warehouse.table("dds.transactions").drop("load_dttm", "p_date"))


@query("partition_replace")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, runs=1)


@query("partition_replace_rerun")
def partition_replace_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, runs=2)


@query("replaced_files_cleaned")
def replaced_files_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days loaded and replaced until versions are dropped, then what none shows is removed: the same rows, and
    the folders that went, which are the loads that no kept version lists."""
    warehouse = _warehouse(spark, "cleaned")
    days = days_between(*_event_bounds(spark, sf_dir))
    replace_days(warehouse, "dds.transactions", _clean(spark, sf_dir), days)
    odd = [d for d in days if d.day % 2 == 1]
    for _ in range(3):
        replace_days(warehouse, "dds.transactions", _clean(spark, sf_dir), odd)
    gone = cleanup.unreachable(warehouse, "dds.transactions", AFTER_ALL).filter(F.col("folder").contains("p_date="))
    counted = gone.groupBy(F.regexp_extract("folder", "p_date=(.*)$", 1).cast("date").alias("p_date"))
    counted = counted.agg(F.count(F.lit(1)).alias("removed_folders"))
    before = spark.createDataFrame(counted.collect(), counted.schema)
    cleanup.clean(warehouse, "dds.transactions", AFTER_ALL)
    left = cleanup.unreachable(warehouse, "dds.transactions", AFTER_ALL).count()
    held = warehouse.table("dds.transactions").groupBy("p_date").agg(F.count(F.lit(1)).alias("stored_rows"))
    told = held.join(before, "p_date", "left").select(
        "p_date", "stored_rows", F.coalesce("removed_folders", F.lit(0)).cast("bigint").alias("removed_folders"),
        F.lit(left).cast("bigint").alias("left_over"),
    )
    return _finished(warehouse, told)
