"""Interleaved keys against plain bits, and how many files a scan by account or time has to read."""

import bisect
from datetime import date

from frames import rows
from pyspark.sql import functions as F

from tallybridge.operators import layout
from tallybridge.plans.clustering import cluster_days, files_with
from tallybridge.plans.partitions import replace_days

DAY, NEXT = date(2024, 5, 1), date(2024, 5, 2)
TABLE = "dds.transactions"


def many(spark, count):
    n = F.xxhash64("id")
    return spark.range(count).select(
        F.concat(F.lit("op"), "id").alias("operation_id"), F.pmod(n, F.lit(50_000)).alias("account_number_from"),
        F.lit(1).cast("bigint").alias("account_number_to"), (410 + 10 * F.pmod(n, F.lit(7))).cast("int").alias("currency_code"),
        F.lit("usa").alias("country"), F.lit("done").alias("status"), F.lit("pay").alias("transaction_type"), F.col("id").alias("amount"),
        F.timestamp_seconds(F.lit(1714521600) + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(172_800))).alias("transaction_dt"),
    ).withColumn("p_date", F.to_date("transaction_dt"))


def test_places_and_bits(spark):
    limits = {"a": [3, 7, 20], "b": [1.5]}
    df = spark.createDataFrame([(a, b) for a in (None, -1, 3, 6, 7, 19, 20, 99) for b in (None, 1.0, 1.5, 2.0)], "a long, b double")
    found = df.select("a", "b", layout.interleaved(df, limits, bits=2).alias("key")).collect()
    for r in found:
        places = [0 if v is None else bisect.bisect_right(own, v) for v, own in zip((r.a, r.b), limits.values(), strict=True)]
        bits = [places[0] >> 1 & 1, places[1] >> 1 & 1, places[0] & 1, places[1] & 1]
        assert r.key == int("".join(map(str, bits)), 2)


def test_a_scan_by_account_reads_a_tenth_of_the_files(warehouse, spark):
    replace_days(warehouse, TABLE, many(spark, 60_000), [DAY, NEXT])
    before = rows(warehouse.table(TABLE))
    by_time = warehouse.table(TABLE).filter(F.col("p_date") == F.lit(DAY)).drop("load_dttm")
    # The layout by time alone in as many files: every file holds accounts from end to end.
    folder = f"{warehouse.root}/by-time"
    by_time.repartitionByRange(150, "transaction_dt").write.parquet(folder)
    spans = spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.min("account_number_from").alias("a"), F.max("account_number_from").alias("b"))
    assert spans.filter("25000 BETWEEN a AND b").count() == spans.count() >= 140
    cluster_days(warehouse, TABLE, [DAY], ["account_number_from", "transaction_dt"], files_a_day=150)
    assert rows(warehouse.table(TABLE)) == before
    read, held = files_with(warehouse, TABLE, "account_number_from", 25_000)
    assert held >= 140 and read <= held * 0.12 + 2
    moment = spark.sql("SELECT timestamp'2024-05-01 13:00:00'").first()[0]
    read, held = files_with(warehouse, TABLE, "transaction_dt", moment)
    assert read <= held * 0.2
