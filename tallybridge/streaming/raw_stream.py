"""Records -> RAW as a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timestamps import load_moment
from ..operators.raw import readable, route, unreadable
from ..plans.ingest import BatchStats, land_batch
from ..plans.warehouse import Warehouse
from ..schemas import COORDINATES, RAW
from ..sources.coordinates import offset_bucket
from ..sources.records import to_raw

# How long a key is remembered where a source can hold a record twice.
REPEAT_HORIZON = "24 hours"
LAYOUT = ["kafka_topic", "kafka_partition", "route", "offset_bucket"]


def raw_rows(records: DataFrame, repeats: bool) -> DataFrame:
    """RAW columns of a record stream, counted as received and as saved.

    Within one checkpoint the Kafka source yields every coordinate once, so no state is
    needed. ``repeats`` is for sources that can hold a record twice, such as files: keys
    read within REPEAT_HORIZON are then kept in the state store and given up after it, so the
    state is bounded by what arrives in that time. It only saves space: a later repeat is in the files
    twice. ``land_files`` and ``land_batch`` hold records against all that RAW ever stored.
    """
    count = F.count(F.lit(1)).alias("rows")
    rows = readable(to_raw(records).observe("received", count))
    if repeats:
        read = rows.withColumn("read_at", F.current_timestamp()).withWatermark("read_at", REPEAT_HORIZON)
        rows = read.dropDuplicatesWithinWatermark(COORDINATES).drop("read_at")
    return rows.observe("saved", count)


def start_rejected(records: DataFrame, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Coordinates of the records that ``start_raw`` leaves out because they have no value."""
    aside = unreadable(to_raw(records)).select(*COORDINATES, F.lit("no value").alias("reject_reason"))
    writer = aside.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_raw(
    records: DataFrame,
    folder: str,
    checkpoint: str,
    repeats: bool = False,
    once: bool = False,
    every: str = "1 second",
) -> StreamingQuery:
    """Append to RAW files. Offsets are logged before a batch and committed after its files.

    ``every`` is how often the source is asked. The Kafka options decide when there is
    enough for a batch; for a source without such options use 30 seconds. A batch
    interrupted by an error or a stop has no commit entry, so a restart runs it again; the
    file sink's log keeps its output single.
    """
    rows = raw_rows(records, repeats).withColumn("load_dttm", load_moment()).withColumns({"route": route(), "offset_bucket": offset_bucket()})
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*LAYOUT)
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def land_files(warehouse: Warehouse, folder: str) -> BatchStats:
    """Land what ``start_raw`` has written so far; records that RAW holds, however old, are not stored again.

    The files of one folder can be landed any number of times: what is known is told from the
    ranges that RAW holds, and its messages are not read.
    """
    files = warehouse.spark.read.schema(RAW).parquet(folder)
    return land_batch(warehouse, files.select(*RAW.fieldNames()))


def start_landing(records: DataFrame, warehouse: Warehouse, checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Land each batch in the RAW table, looked up against what it holds; ``raw.batch_stats`` gets its figures.

    Source offsets are committed after the table write. A batch that is run again after a
    failure, or a new checkpoint that starts from the earliest offset, saves nothing twice.
    """

    def land(batch: DataFrame, _: int) -> None:
        land_batch(replace(warehouse, spark=batch.sparkSession), to_raw(batch))

    writer = records.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def batch_counts(query: StreamingQuery) -> list[tuple[int, int]]:
    """Records received and saved, for each of the query's recent batches that had any."""
    figures = [p["observedMetrics"] for p in query.recentProgress if p["numInputRows"] > 0]
    return [(f["received"]["rows"], f["saved"]["rows"]) for f in figures if "received" in f and "saved" in f]


def offsets_read(query: StreamingQuery) -> list[dict]:
    """Start, end and latest offset of each source in the last batch."""
    progress = query.lastProgress
    sources = progress["sources"] if progress else []
    return [{key: source[key] for key in ("description", "startOffset", "endOffset", "latestOffset")} for source in sources]
