"""Counted distinct rows against rebuilds from scratch, and bitmaps of senders against sets."""

import random
from datetime import date, datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallybridge.operators import cleaning, metrics, senders
from tallybridge.plans import incremental, users
from tallybridge.schemas import TRANSACTIONS

DAYS = [date(2024, 3, d) for d in (1, 2, 3)]


def row(n, account=None, currency=410, day=1, status="done", amount=None):
    account = n % 5 if account is None else account
    moment = datetime(2024, 3, day, 12, 0, n % 60)
    return (f"op{n}", account, 9, currency, "usa", status, "pay", n * 7 - 20 if amount is None else amount, moment)


def frame(spark, *found):
    return spark.createDataFrame(list(found), TRANSACTIONS)


def rebuilt(spark, held):
    return rows(metrics.turnover(cleaning.clean_transactions(frame(spark, *held))).select("date_update", "currency_from", "minor_units", "cnt_transactions", "cnt_accounts_make_transactions"))


def kept(warehouse):
    return rows(incremental.turnover(warehouse).select("date_update", "currency_from", "minor_units", "cnt_transactions", "cnt_accounts_make_transactions"))


def test_any_batches_equal_a_rebuild(warehouse, spark):
    draw = random.Random(5)
    pool = [row(n, currency=410 + 10 * (n % 2), day=1 + n % 3, status=draw.choice(["done", "done", "queued"])) for n in range(18)]
    pool += [row(30, account=-1), row(31, account=3, amount=0)]
    held = []
    for _ in range(4):
        added = [draw.choice(pool) for _ in range(10)]
        withdrawn = draw.sample(held, min(len(held), 6))
        batch = frame(spark, *added).withColumn("weight", F.lit(1))
        if withdrawn:
            batch = batch.unionByName(frame(spark, *withdrawn).withColumn("weight", F.lit(-1)))
        incremental.apply_changes(warehouse, batch)
        held += added
        for one in withdrawn:
            held.remove(one)
        assert kept(warehouse) == rebuilt(spark, held)


def test_a_late_row_reads_its_part_of_its_day(warehouse, spark):
    incremental.apply_changes(warehouse, frame(spark, *[row(n, day=1 + n % 3) for n in range(60)]))
    late = incremental.D.row_changes(frame(spark, row(99, day=2)).withColumn("weight", F.lit(1)))
    plan = incremental._touched(warehouse, "dds.row_copies", late)._jdf.queryExecution().executedPlan().toString()
    copies = next(line for line in plan.splitlines() if "FileScan" in line and "operation_id" in line)
    assert "p_date#" in copies.split("PartitionFilters: [")[1].split("]")[0] and "bucket" in copies.split("PushedFilters: [")[1].split("]")[0]
    told = incremental.apply_changes(warehouse, frame(spark, row(99, day=2), row(99, day=2)))
    assert (told.rows, told.senders, told.days) == (1, 0, [DAYS[1]])
    assert incremental.apply_changes(warehouse, frame(spark, row(99, day=2))).rows == 0


def test_a_batch_that_fails_counts_for_nothing(warehouse, spark, monkeypatch):
    incremental.apply_changes(warehouse, frame(spark, row(1), row(2)))
    before = kept(warehouse)
    with monkeypatch.context() as patch:
        append = type(warehouse).append
        patch.setattr(type(warehouse), "append", lambda self, t, df: (_ for _ in ()).throw(RuntimeError("lost")) if t == "dds.deltas" else append(self, t, df))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.apply_changes(warehouse, frame(spark, row(3)))
    assert kept(warehouse) == before
    incremental.apply_changes(warehouse, frame(spark, row(3)))
    assert kept(warehouse) == rebuilt(spark, [row(1), row(2), row(3)])


def test_more_withdrawn_than_added_ends_the_batch(warehouse, spark):
    incremental.apply_changes(warehouse, frame(spark, row(1)))
    with pytest.raises(Exception, match="withdrawn more often than added: op1"):
        incremental.apply_changes(warehouse, frame(spark, row(1), row(1)).withColumn("weight", F.lit(-1)))
    assert kept(warehouse) == rebuilt(spark, [row(1)])


def test_bitmaps_add_up_like_sets(warehouse, spark):
    draw = random.Random(1)
    accounts = [3, 7, 10**15, -4, *range(100, 140), *range(5_000_000, 5_000_030)]
    told = [(draw.choice(DAYS), draw.choice([410, 420, 430]), draw.choice(accounts)) for _ in range(400)]
    found = spark.createDataFrame(told, "date_update date, currency_from int, account_number_from long")
    for part in (found.filter("account_number_from < 110"), found):
        users.number_accounts(warehouse, part)
    numbers = rows(warehouse.table("dds.dim_account").select("account_id"))
    assert sorted(n for (n,) in numbers) == list(range(1, len({a for *_, a in told}) + 1))
    bits = senders.sender_bits(found, warehouse.table("dds.dim_account"))
    assert rows(senders.unique_users(bits)) == [(len({a for *_, a in told}),)]
    by_day = {d: len({a for e, _, a in told if e == d}) for d in {d for d, *_ in told}}
    assert {r.date_update: r.unique_users for r in senders.unique_users(bits, ["date_update"]).collect()} == by_day
    two = bits.filter(F.col("date_update").isin(*DAYS[:2]) & F.col("currency_from").isin(410, 430))
    assert rows(senders.unique_users(two)) == [(len({a for d, c, a in told if d in DAYS[:2] and c in (410, 430)}),)]


def test_bitmaps_over_several_buckets(spark):
    accounts = spark.range(1, 70_001).select(F.col("id").alias("account_number"), F.col("id").alias("account_id"))
    found = spark.range(1, 70_001).select(
        F.lit(DAYS[0]).alias("date_update"), (F.col("id") % 2).cast("int").alias("currency_from"), F.col("id").alias("account_number_from")
    )
    bits = senders.sender_bits(found.unionByName(found), accounts)
    assert bits.count() == 6 and rows(senders.unique_users(bits)) == [(70_000,)]


def test_the_view_function_filters_below_the_spine(warehouse, spark):
    warehouse.fill_calendar("2024-03-01", "2024-03-31")
    plan = warehouse.metrics_between(DAYS[0], DAYS[1], [410])._jdf.queryExecution().executedPlan().toString()
    mart = next(line for line in plan.splitlines() if "FileScan" in line and "amount_total" in line)
    assert "p_date#" in mart.split("PartitionFilters: [")[1].split("]")[0] and "2024-03-01" in mart
    currencies = next(line for line in plan.splitlines() if "FileScan" in line and "currency_iso_code" in line)
    assert "currency_code" in currencies.split("DataFilters: [")[1] and "410" in plan
    assert warehouse.metrics_between(DAYS[1], DAYS[0]).count() == 0
    assert spark.catalog.currentDatabase() == "default"
