"""Counted distinct rows: what late and withdrawn rows change, told from counts alone.

A row counts as long as at least one copy of it is there, a sender as long as one of their rows is. With
the copies per row and the rows per sender at hand, a change to either is a step from none to some or
back, so turnover follows from the rows that changed and the counts of these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DONE, TRANSACTION_COLUMNS

#: Parts of a day that counts are ordered by, a hash of what is counted: a late row reads the row groups of one.
BUCKETS = 256
SENDER = ["p_date", "currency_code", "account_number_from"]


def bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def step(before: Column, change: Column) -> Column:
    """1 where something appears, -1 where it is gone, 0 where it stays or stays away."""
    return (before + change > 0).cast("int") - (before > 0).cast("int")


def row_changes(rows: DataFrame, weight: str = "weight") -> DataFrame:
    """Rows of real accounts with the copies they gain, or lose where the ``weight`` is negative.

    Copies inside the batch combine before the shuffle; what comes and goes within it is no change.
    """
    real = (F.col("account_number_from") >= 0) & (F.col("account_number_to") >= 0)
    summed = rows.filter(real).groupBy(*TRANSACTION_COLUMNS).agg(F.sum(F.col(weight).cast("bigint")).alias("change"))
    dated = summed.filter("change <> 0").withColumn("p_date", F.to_date("transaction_dt"))
    return dated.withColumn("bucket", bucket(*TRANSACTION_COLUMNS))


def _met(changes: DataFrame, held: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """``changes`` with what ``held`` has of the same keys, as ``before_*``; nulls are equal to nulls."""
    none = lambda names: [F.lit(0).cast("bigint").alias(n) for n in names]
    before = [f"before_{s}" for s in sums]
    both = changes.select(*keys, *sums, *none(before), F.lit(1).alias("changed")).unionByName(
        held.select(*keys, *none(sums), *[F.col(s).alias(b) for s, b in zip(sums, before, strict=True)], F.lit(0).alias("changed"))
    )
    found = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, *before)], F.max("changed").alias("changed"))
    return found.filter("changed = 1").drop("changed")


def row_steps(changes: DataFrame, copies: DataFrame) -> DataFrame:
    """Changed rows with ``step``; ``copies`` (rows, change) is the log of copies of the parts that are touched.

    More copies withdrawn than there are end the job: the counts would no longer be those of any table.
    """
    found = _met(changes, copies, [*TRANSACTION_COLUMNS, "p_date"], ["change"])
    left = F.col("before_change") + F.col("change")
    wrong = F.concat(F.lit("withdrawn more often than added: "), F.coalesce("operation_id", F.lit("a row without an id")))
    checked = F.when(left < 0, F.raise_error(wrong).cast("bigint")).otherwise(F.col("change"))
    return found.withColumn("change", checked).withColumn("step", step(F.col("before_change"), F.col("change")))


def sender_changes(steps: DataFrame) -> DataFrame:
    """Rows and turnover that senders gain or lose by day and currency, of completed transactions."""
    moved = steps.filter((F.col("step") != 0) & (F.col("status") == DONE))
    found = moved.groupBy(*SENDER).agg(
        F.sum("step").cast("bigint").alias("transactions"), F.sum(F.col("step") * F.abs("amount")).alias("minor_units")
    )
    return found.withColumn("bucket", bucket(*SENDER))


def sender_steps(changes: DataFrame, held: DataFrame) -> DataFrame:
    """Changed senders with ``step``; ``held`` is the log of the parts that are touched."""
    found = _met(changes, held, SENDER, ["transactions", "minor_units"])
    return found.withColumn("step", step(F.col("before_transactions"), F.col("transactions")))


def turnover_changes(steps: DataFrame) -> DataFrame:
    """What days and currencies gain or lose."""
    return steps.groupBy("p_date", "currency_code").agg(
        F.sum("minor_units").alias("minor_units"),
        F.sum("transactions").alias("cnt_transactions"),
        F.sum("step").cast("bigint").alias("cnt_accounts"),
    )


def turnover(changes: DataFrame) -> DataFrame:
    """Turnover per day and currency from its changes, as the mart is built from."""
    summed = changes.groupBy(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from")).agg(
        F.sum("minor_units").alias("minor_units"),
        F.sum("cnt_transactions").alias("cnt_transactions"),
        F.sum("cnt_accounts").alias("cnt_accounts_make_transactions"),
    )
    return summed.filter("cnt_transactions > 0")
