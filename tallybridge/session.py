"""Session settings and the shared folder jobs may write to."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Partitions merge up to the advisory size, also where that leaves cores idle: a small
    # day rebuilt on a large cluster then writes few files without a further shuffle.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The older physical form of timestamps has no statistics, so nothing could be skipped by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Recording the call site of every column expression costs several JVM calls each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


MB = 1024 * 1024
TB = 1024 * 1024 * MB


def sizing(input_bytes: int) -> dict[str, str]:
    """Partition sizes for jobs that read about ``input_bytes``.

    AQE merges shuffle partitions but cannot split those of an aggregate, so their number has
    to start high enough; and every map task keeps a block per shuffle partition, so it must
    not grow as fast as the input. Both follow from one size of a partition: 128 MB for 1 TB, and
    twice that for four times the input. At 100 TB, 82,000 scan tasks meet as many partitions of 1.3 GB
    at most, of which a map-side combine leaves a part.
    """
    part = math.ceil(128 * MB * max(1.0, math.sqrt(input_bytes / TB)))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(1, math.ceil(input_bytes / part))),
        "spark.sql.files.maxPartitionBytes": str(part),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part // 2),
    }


def build_session(
    app: str = "tallybridge", master: str | None = None, input_bytes: int = TB, **extra: str
) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots.

    Partitions are sized for ``input_bytes``. A number of shuffle partitions in ``extra`` is where
    AQE then starts from.
    """
    settings = {**SETTINGS, **sizing(input_bytes)}
    if "spark__sql__shuffle__partitions" in extra:
        settings.pop("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    settings |= {key.replace("__", "."): value for key, value in extra.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day boundaries are UTC in every layer, whatever the session was started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is set up only for a local master with nothing configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tallybridge-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
