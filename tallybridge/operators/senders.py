"""Exact distinct senders of any slice of the mart: a bit per account, merged by OR.

Accounts get dense numbers, so a bitmap of 4 KB covers 32,768 of them and sets of senders add up
exactly, whatever days and currencies are put together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["date_update", "currency_from"]


def new_accounts(seen: DataFrame, known: DataFrame) -> DataFrame:
    """Accounts of ``seen`` that ``known`` does not hold, each once."""
    return seen.select("account_number").distinct().join(known.select("account_number"), "account_number", "left_anti")


def numbered(accounts: DataFrame, start: int, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(account_number, account_id): distinct accounts with dense numbers from ``start``.

    ``write`` stores a frame and reads it back. The parts of what it stored are numbered side by side and moved by the
    sizes of the parts before them, of which there are as many as tasks; no task sees all accounts.
    """
    dealt = write(accounts.withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("part").count().orderBy("part").collect()
    before, total = [], start
    for part, count in sizes:
        before.append((part, total))
        total += count
    moved = dealt.sparkSession.createDataFrame(before, "part int, before bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy("account_number"))
    return dealt.withColumn("place", place).join(moved, "part").select(
        "account_number", (F.col("before") + F.col("place") - 1).alias("account_id")
    )


def sender_bits(senders: DataFrame, accounts: DataFrame) -> DataFrame:
    """(date_update, currency_from, bucket, bits) from (day, currency, sender) rows; bits combine in every task."""
    known = accounts.select(F.col("account_number").alias("account_number_from"), "account_id")
    met = senders.select(*KEYS, "account_number_from").distinct().join(known, "account_number_from")
    return met.groupBy(*KEYS, F.bitmap_bucket_number("account_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("account_id")).alias("bits")
    )


def unique_users(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct senders of all days and currencies of ``bits``, overall or ``by`` a mart key.

    First the bitmaps of a bucket are merged, combining in every task, then their bits are counted. So a
    slice costs its bitmaps, not its transactions.
    """
    merged = bits.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_users"))


def dashboard_from_bits(mart: DataFrame, bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The dashboard's figures from mart and bitmaps alone; equal to counting the transactions again.

    A day and currency with several rates has several mart rows, but its transactions count once.
    """
    volume = mart.groupBy(*by).agg(F.sum("amount_total").cast("decimal(28,2)").alias("amount_total"))
    once = mart.select(*KEYS, "cnt_transactions").distinct()
    count = once.groupBy(*by).agg(F.sum("cnt_transactions").alias("cnt_transactions"))
    users = unique_users(bits.join(mart.select(*KEYS).distinct(), KEYS, "left_semi"), by)
    keys = list(by)
    if not keys:  # one row each, met through a constant key
        keys = ["one"]
        volume, count, users = (df.withColumn("one", F.lit(1)) for df in (volume, count, users))
    joined = volume.join(count, keys).join(users, keys)
    mean = (F.col("cnt_transactions") / F.col("unique_users")).alias("avg_transactions_per_user")
    return joined.select(*by, "amount_total", "cnt_transactions", "unique_users", mean)
