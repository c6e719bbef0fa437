"""RAW -> STG as a stream: one query and one checkpoint per target, as independent cursors."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.days import with_day
from ..functions.timestamps import load_moment
from ..operators.raw import readable_by
from ..operators.staging import PARSERS, rejected, staged
from ..plans.ingest import DAY_SOURCES, stage_batch
from ..plans.warehouse import Warehouse

RAW_FILES = (
    "kafka_offset bigint, kafka_message string, load_dttm timestamp, "
    "kafka_topic string, kafka_partition int, route string, offset_bucket bigint"
)


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """The RAW folder as a stream of its new files."""
    return spark.readStream.schema(RAW_FILES).parquet(folder)


def start_staging(
    raw: DataFrame, object_type: str, folder: str, checkpoint: str, mode: str = "quarantine", once: bool = False
) -> StreamingQuery:
    rows = staged(PARSERS[object_type](readable_by(raw, object_type)), object_type, mode)
    stamped = with_day(rows, DAY_SOURCES[object_type]).withColumn("load_dttm", load_moment())
    writer = (
        stamped.writeStream.format("parquet")
        .partitionBy("p_date")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_staging_table(
    raw: DataFrame, object_type: str, warehouse: Warehouse, checkpoint: str, mode: str = "quarantine"
) -> StreamingQuery:
    """Load each batch of RAW rows into the target's staging table, its rejects and the load log."""

    def stage(batch: DataFrame, _: int) -> None:
        stage_batch(replace(warehouse, spark=batch.sparkSession), readable_by(batch, object_type), object_type, mode)

    return raw.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).start()


def start_quarantine(
    raw: DataFrame, object_type: str, folder: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """The messages ``start_staging`` leaves out, with the reason."""
    aside = rejected(PARSERS[object_type](readable_by(raw, object_type)))
    writer = aside.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
