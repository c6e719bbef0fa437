"""Replacing days: reruns, days that became empty, untouched neighbours, range = day loop."""

import uuid
from datetime import date

import pytest
from frames import rows
from golden import staged
from pyspark.sql import functions as F

from tallybridge.operators import cleaning
from tallybridge.plans import build
from tallybridge.plans.partitions import days_between, partition_id, replace_days
from tallybridge.plans.warehouse import Warehouse
from tallybridge.session import fresh_dir

D1, D2, D3 = date(2022, 10, 1), date(2022, 10, 2), date(2022, 10, 3)
TABLE = "dds.transactions"


@pytest.fixture
def clean(spark):
    return cleaning.clean_transactions(staged(spark)[0])


def content(warehouse, table=TABLE):
    return rows(warehouse.table(table).drop("load_dttm"))


def per_day(warehouse):
    return {r[0]: r[1] for r in warehouse.table(TABLE).groupBy("p_date").count().collect()}


def test_rerun_gives_the_same_rows(warehouse, clean):
    assert replace_days(warehouse, TABLE, clean, [D1, D2]) == {D1, D2}
    before = content(warehouse)
    replace_days(warehouse, TABLE, clean, [D1])
    replace_days(warehouse, TABLE, clean, [D1, D2, D3])
    assert content(warehouse) == before and len(before) == 7


def test_day_that_became_empty_is_cleared_and_others_stay(warehouse, clean):
    replace_days(warehouse, TABLE, clean, [D1, D2])
    assert replace_days(warehouse, TABLE, clean.limit(0), [D1]) == set()
    assert per_day(warehouse) == {D2: 1}


def test_rows_outside_the_requested_days_are_not_written(warehouse, clean):
    replace_days(warehouse, TABLE, clean, [D2])
    assert per_day(warehouse) == {D2: 1}
    replace_days(warehouse, TABLE, clean, [D1, D3])
    assert per_day(warehouse) == {D1: 6, D2: 1}


def test_table_can_be_rebuilt_from_itself(warehouse, clean):
    replace_days(warehouse, TABLE, clean, [D1, D2])
    reader = warehouse.table(TABLE)
    replace_days(warehouse, TABLE, reader.filter("status = 'done'").drop("load_dttm"), [D1])
    assert per_day(warehouse) == {D1: 5, D2: 1}


def test_failed_write_leaves_the_day(warehouse, clean):
    replace_days(warehouse, TABLE, clean, [D1])
    broken = clean.withColumn("amount", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        replace_days(warehouse, TABLE, broken, [D1])
    assert per_day(warehouse) == {D1: 6}


def test_day_filter_prunes_to_one_directory(warehouse, clean):
    replace_days(warehouse, TABLE, clean, [D1, D2])
    plan = warehouse.table(TABLE).filter(F.col("p_date") == F.lit(D2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan


def test_time_range_reaches_the_file_scan(warehouse, clean):
    from tallybridge.functions.days import day_slice

    replace_days(warehouse, TABLE, clean, [D1, D2])
    sliced = day_slice(warehouse.table(TABLE), "transaction_dt", D2)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan
    assert "GreaterThanOrEqual(transaction_dt," in plan
    assert sliced.count() == 1


def test_range_equals_day_loop(spark):
    results = []
    for days in ([(D1, D2)], [(D1, D1), (D2, D2)]):
        warehouse = Warehouse(spark, fresh_dir(spark, "loop"), f"t{uuid.uuid4().hex[:8]}_").create()
        transactions, rates = staged(spark)
        later = transactions.withColumn("transaction_dt", F.expr("transaction_dt + INTERVAL 2 DAYS"))
        quoted = rates.withColumn("date_update", F.expr("date_update + INTERVAL 2 DAYS"))
        for table, frames, moment in (
            ("stg.transactions", (transactions, later), "transaction_dt"),
            ("stg.currencies", (rates, quoted), "date_update"),
        ):
            for frame in frames:
                warehouse.append(table, frame.withColumn("p_date", F.to_date(moment)))
        for first, last in days:
            build.backfill(warehouse, first, last)
        results.append([content(warehouse, t) for t in (TABLE, "dds.currencies", "dds.dim_currency", "cdm.global_metrics")])
        warehouse.drop()
    assert results[0] == results[1]
    assert [len(part) for part in results[0]] == [7, 5, 4, 5]


def test_partition_ids():
    assert partition_id(D1) == 20221001
    assert days_between(D1, D3) == [D1, D2, D3]


def test_a_range_is_switched_at_once(warehouse, clean, monkeypatch):
    replace_days(warehouse, TABLE, clean, [D1, D2])
    early = warehouse.table(TABLE)
    early.count()
    done = clean.filter("status = 'done'")
    seen = []
    sql = type(warehouse.spark).sql

    def watched(self, text, *args, **kwargs):
        if text.startswith("ALTER") and "__" in text:
            seen.append((text.split()[1], per_day(warehouse)))
        return sql(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(warehouse.spark), "sql", watched)
        replace_days(warehouse, TABLE, done, [D1, D2])
    # Until the view changes, which is the last step and one statement, all days are as they were.
    assert seen == [("TABLE", {D1: 6, D2: 1}), ("VIEW", {D1: 6, D2: 1})]
    assert per_day(warehouse) == {D1: 5, D2: 1}
    assert early.count() == 7


@pytest.mark.parametrize("stopped", ["ALTER TABLE", "ALTER VIEW"])
def test_a_switch_that_fails_halfway_leaves_all_days(warehouse, clean, monkeypatch, stopped):
    replace_days(warehouse, TABLE, clean, [D1, D2])
    sql = type(warehouse.spark).sql

    def broken(self, text, *args, **kwargs):
        if text.startswith(stopped):
            raise RuntimeError("lost")
        return sql(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(warehouse.spark), "sql", broken)
        with pytest.raises(RuntimeError, match="lost"):
            replace_days(warehouse, TABLE, clean.filter("status = 'done'"), [D1, D2])
    assert per_day(warehouse) == {D1: 6, D2: 1}
    replace_days(warehouse, TABLE, clean.filter("status = 'done'"), [D1, D2])
    assert per_day(warehouse) == {D1: 5, D2: 1}


def test_old_versions_leave_the_catalog(warehouse, clean):
    for _ in range(5):
        replace_days(warehouse, TABLE, clean, [D1])
    schema, short = warehouse.name(TABLE).split(".")
    assert warehouse.spark.sql(f"SHOW TABLES IN {schema} LIKE '{short}__0*'").count() == 3
    assert per_day(warehouse) == {D1: 6}


def test_a_killed_backfill_goes_on_where_it_was(warehouse, spark, monkeypatch):
    transactions, rates = staged(spark)
    for days in (0, 1, 2, 3):
        for table, frame, moment in (("stg.transactions", transactions, "transaction_dt"), ("stg.currencies", rates, "date_update")):
            moved = frame.withColumn(moment, F.col(moment) + F.expr(f"INTERVAL {2 * days} DAYS"))
            warehouse.append(table, moved.withColumn("p_date", F.to_date(moment)))
    last = date(2022, 10, 6)
    calls = []
    dds, mart = build.build_dds, build.build_mart
    monkeypatch.setattr(build, "build_dds", lambda w, days, *a: calls.append(("dds", *days)) or dds(w, days, *a))

    def dies(w, upstream, *a):
        if len(calls) == 2:
            raise RuntimeError("killed")
        return mart(w, upstream, *a)

    with monkeypatch.context() as patch:
        patch.setattr(build, "build_mart", dies)
        with pytest.raises(RuntimeError, match="killed"):
            build.resume_backfill(warehouse, "all", D1, last, chunk=2)
    statuses = build.resume_backfill(warehouse, "all", D1, last, chunk=2)
    assert calls == [("dds", D1, D2), ("dds", D3, date(2022, 10, 4)), ("dds", date(2022, 10, 5), last)]
    whole = content(warehouse, "cdm.global_metrics")
    assert {(s.layer, s.process_date) for s in statuses} == {(layer, d) for layer in ("dds", "cdm") for d in days_between(D1, last)}
    assert build.resume_backfill(warehouse, "all", D1, last, chunk=2) == statuses and len(calls) == 3
    build.backfill(warehouse, D1, last)
    assert content(warehouse, "cdm.global_metrics") == whole
