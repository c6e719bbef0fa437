"""Stream records: Kafka options, the projection into RAW columns, and file stand-ins.

The Kafka source and a folder of files with the same columns feed the same
functions, so everything after the reader can be run without a broker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FLUSH_ROWS, FLUSH_SECONDS

# Columns of the Kafka source that are read here.
RECORD_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, value binary"


@dataclass(frozen=True)
class KafkaSettings:
    host: str
    port: int
    topic: str
    group: str
    user: str
    password: str
    cert_path: str
    batch_rows: int = FLUSH_ROWS
    batch_seconds: int = FLUSH_SECONDS
    largest_batch: int = 50_000_000
    records_per_task: int = 1_000_000

    def connection(self) -> dict[str, str]:
        login = (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{self.user}" password="{self.password}";'
        )
        return {
            "kafka.bootstrap.servers": f"{self.host}:{self.port}",
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config": login,
            "kafka.ssl.truststore.type": "PEM",
            "kafka.ssl.truststore.location": self.cert_path,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
            # A gap or a reader error ends the query; nothing is skipped silently.
            "failOnDataLoss": "true",
            # A stream partition with most of the records is read by several tasks.
            "maxRecordsPerPartition": str(self.records_per_task),
        }

    def stream_options(self) -> dict[str, str]:
        """A batch starts at ``batch_rows`` records or after ``batch_seconds``, whichever is first.

        It then takes what is there: a backlog is worked off in large batches, not 5,000 at a time.
        """
        return {
            **self.connection(),
            "groupIdPrefix": self.group,
            "minOffsetsPerTrigger": str(self.batch_rows),
            "maxOffsetsPerTrigger": str(max(self.batch_rows, self.largest_batch)),
            "maxTriggerDelay": f"{self.batch_seconds}s",
        }

    def replay_options(self) -> dict[str, str]:
        """One bounded read of everything the broker still holds."""
        return {**self.connection(), "endingOffsets": "latest"}


def kafka_stream(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    return spark.readStream.format("kafka").options(**settings.stream_options()).load()


def kafka_replay(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    return spark.read.format("kafka").options(**settings.replay_options()).load()


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files that hold records, read as a stream."""
    reader = spark.readStream.format("parquet").schema(RECORD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def to_raw(records: DataFrame) -> DataFrame:
    """Coordinates and the UTF-8 text of the value, untouched."""
    return records.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("kafka_message"),
    )
