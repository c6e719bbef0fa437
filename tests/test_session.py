"""Partition sizing and the shared folder."""

from tallybridge.session import MB, TB, fresh_dir, shared_dir, sizing

START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_sizing_grows_with_the_input():
    small, medium, large = sizing(MB), sizing(TB), sizing(100 * TB)
    assert [int(size[START]) for size in (small, medium, large)] == [1, 8192, 81920]
    scans = [int(size["spark.sql.files.maxPartitionBytes"]) // MB for size in (small, medium, large)]
    files = [int(size["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) // MB for size in (small, medium, large)]
    assert (scans, files) == ([128, 128, 1280], [64, 64, 640])
    starts = [int(sizing(n * TB)[START]) for n in range(1, 400)]
    assert starts == sorted(starts) and max(b - a for a, b in zip(starts, starts[1:], strict=False)) < 4000


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")
    assert fresh_dir(spark, "a").startswith(shared_dir(spark))


def test_days_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
