"""Expected values of the micro-fixture, operator by operator and through the tables."""

from datetime import date
from decimal import Decimal

import pytest
from frames import rows
from golden import DIMENSION, MART, staged, uid
from pyspark.sql import functions as F

from tallybridge.functions.money import minor_to_base
from tallybridge.operators import cleaning, dimensions, metrics, quality, reports
from tallybridge.plans import build, ingest
from tallybridge.sources.calendar import calendar, day_range

D1, D2 = date(2022, 10, 1), date(2022, 10, 2)


@pytest.fixture(scope="module")
def layers(spark):
    transactions, rates = staged(spark)
    return transactions, rates, cleaning.clean_transactions(transactions), cleaning.normalize_rates(rates)


def test_clean_transactions_drop_copies_and_test_accounts(layers):
    clean = layers[2]
    ids = sorted(r.operation_id for r in clean.collect())
    assert ids == [uid(s) for s in ("a1", "a2", "a3", "a4", "a7", "a8", "a9")]
    assert clean.filter(F.col("p_date") == D1).count() == 6


def test_rows_that_differ_under_one_id_all_stay(spark, layers):
    twin = layers[0].filter(F.col("operation_id") == uid("a8")).withColumn("amount", F.lit(102).cast("bigint"))
    assert cleaning.clean_transactions(layers[0].unionByName(twin)).count() == 8


def test_rates_collapse_at_day_grain(layers):
    assert layers[3].count() == 5


def test_dimension(spark, layers):
    empty = spark.createDataFrame([], "currency_code int")
    assert rows(dimensions.new_currencies(layers[2], empty)) == DIMENSION


def test_known_codes_and_later_countries_do_not_enter(spark, layers):
    known = spark.createDataFrame([(430,)], "currency_code int")
    later = layers[2].filter(F.col("operation_id") == uid("a4")).withColumn("country", F.lit("canada"))
    later = later.withColumn("p_date", F.lit(D2))
    grown = dimensions.new_currencies(layers[2].unionByName(later), known)
    assert rows(grown) == [r for r in DIMENSION if r[0] != 430]


def test_two_countries_on_the_first_day_conflict(spark, layers):
    same_day = layers[2].filter(F.col("operation_id") == uid("a4")).withColumn("country", F.lit("canada"))
    empty = spark.createDataFrame([], "currency_code int")
    grown = dimensions.new_currencies(layers[2].unionByName(same_day), empty)
    assert rows(dimensions.currency_conflicts(grown)) == [(420, 2, "canada", "usa")]


def test_mart(spark, layers):
    mart = metrics.global_metrics(layers[2], layers[3], day_range(spark, D1, D1, "rate_date"))
    assert rows(mart.drop("date_update")) == MART


def test_stored_base_rate_gives_a_second_row(spark, layers):
    own = spark.sql("SELECT DATE'2022-10-01' AS rate_date, 420 AS currency_from, 420 AS currency_to, "
                    "CAST(2 AS DECIMAL(18,8)) AS currency_rate")
    mart = metrics.global_metrics(layers[2], layers[3].unionByName(own), day_range(spark, D1, D1, "rate_date"))
    assert [r.amount_total for r in mart.filter("currency_from = 420").orderBy("amount_total").collect()] == [
        Decimal("3.33"), Decimal("6.66")]


def test_checks(layers):
    _, _, clean, rates = layers
    assert rows(quality.missing_rates(clean, rates)) == [(D1, 470)]
    assert rows(quality.ambiguous_rates(rates)) == [(D1, 450, 2, Decimal("0.05000000"), Decimal("0.06000000"))]
    assert quality.holds_day(clean, "p_date", D2) and not quality.holds_day(clean, "p_date", date(2022, 10, 3))


def test_readiness_needs_a_later_day_in_both(spark, layers):
    days = day_range(spark, "2022-09-30", D2, "process_date")
    ready = quality.day_readiness(days, layers[0], layers[1])
    assert [r.ready for r in ready.orderBy("process_date").collect()] == [True, True, False]
    nothing = quality.day_readiness(days, layers[0], layers[1].limit(0))
    assert {r.ready for r in nothing.collect()} == {False}


def test_view_fills_gaps(spark, layers):
    _, _, clean, rates = layers
    mart = metrics.global_metrics(clean, rates, day_range(spark, D1, D1, "rate_date"))
    currencies = dimensions.new_currencies(clean, spark.createDataFrame([], "currency_code int"))
    days = calendar(day_range(spark, "2022-09-30", D2))
    view = reports.gap_filled(mart, days, currencies).collect()
    assert len(view) == 5
    assert {(r.date_update, r.year, r.quarter, r.month) for r in view} == {(D1, 2022, 4, 10)}
    zero = [r for r in view if r.currency_from == 470]
    assert [tuple(r)[-4:] for r in zero] == [(Decimal("0.00"), 0, 0.0, 0)]


def test_view_of_an_empty_mart_has_no_rows(spark, layers):
    mart = metrics.global_metrics(layers[2].limit(0), layers[3], day_range(spark, D1, D1, "rate_date"))
    currencies = spark.createDataFrame(DIMENSION, "currency_code int, country string, currency_iso_code string")
    assert reports.gap_filled(mart, calendar(day_range(spark, D1, D2)), currencies).count() == 0


@pytest.mark.parametrize(
    "minor, rate, expected",
    [(114126, "0.75", "855.95"), (12550, "0.98", "122.99"), (101, "0.05", "0.05"), (9_000_000_000_000_000, "0.00000001", "900000.00")],
)
def test_money_is_exact_and_rounds_half_up(spark, minor, rate, expected):
    value = minor_to_base(F.lit(minor).cast("bigint"), F.lit(rate).cast("decimal(18,8)"))
    assert spark.range(1).select(value).first()[0] == Decimal(expected)


def _load(warehouse):
    transactions, rates = staged(warehouse.spark)
    ingest.append_staged(warehouse, "stg.transactions", transactions)
    ingest.append_staged(warehouse, "stg.currencies", rates)


def test_warehouse_build(warehouse):
    _load(warehouse)
    warehouse.fill_calendar("2022-09-30", "2022-10-02")
    statuses = build.backfill(warehouse, date(2022, 9, 30), D2)
    found = {(s.layer, s.process_date): s.status for s in statuses}
    assert found == {
        ("dds", date(2022, 9, 30)): build.FAILED,
        ("dds", D1): build.BUILT,
        ("dds", D2): build.NOT_READY,
        ("cdm", date(2022, 9, 30)): build.SKIPPED,
        ("cdm", D1): build.FAILED,
    }
    assert rows(warehouse.table("cdm.global_metrics").drop("date_update", "p_date")) == MART
    assert rows(warehouse.table("dds.dim_currency").drop("load_dttm")) == DIMENSION
    assert warehouse.table("cdm.v_global_metrics").count() == 5
    with pytest.raises(build.QualityError, match="470"):
        build.require(statuses)
    with pytest.raises(build.QualityError, match="470"):
        build.require_base_rates(warehouse, D1)
    build.require_transactions(warehouse, D1)
    with pytest.raises(build.QualityError):
        build.require_rates(warehouse, D2)


def test_gate_before_publishing_holds_the_day_back(warehouse):
    _load(warehouse)
    below = build.build_dds(warehouse, [D1])
    statuses = build.build_mart(warehouse, below, gate="before")
    assert [s.status for s in statuses] == [build.FAILED]
    assert warehouse.table("cdm.global_metrics").count() == 0


def test_missing_rates_are_a_table(warehouse):
    _load(warehouse)
    build.backfill(warehouse, D1, D1)
    assert rows(warehouse.table("cdm.missing_rates").drop("p_date")) == [(D1, 470)]


def test_latest_rate_of_the_day(spark, layers):
    rates = cleaning.normalize_rates(layers[1], "latest")
    assert rows(rates.filter("currency_from = 450")) == [(D1, 450, 420, Decimal("0.06000000"))]
    assert rates.count() == 4
    with pytest.raises(ValueError, match="unknown rate policy"):
        cleaning.normalize_rates(layers[1], "first")


def test_days_that_no_calendar_has_do_not_stop_a_build(warehouse):
    _load(warehouse)
    warehouse.spark.sql(f"ALTER TABLE {warehouse.name('stg.transactions')} ADD PARTITION (p_date = '0000-01-01')")
    assert warehouse.days("stg.transactions") == {D1, D2}
    assert {s.status for s in build.backfill(warehouse, D1, D1)} == {build.BUILT, build.FAILED}


def test_staged_days_have_few_files(warehouse):
    transactions, _ = staged(warehouse.spark)
    ingest.append_staged(warehouse, "stg.transactions", transactions.repartition(20))
    files = warehouse.table("stg.transactions").inputFiles()
    assert len(files) == 2, files


def test_calendar_fill_is_repeatable(warehouse):
    warehouse.fill_calendar()
    warehouse.fill_calendar()
    assert warehouse.table("dds.dim_calendar").count() == 3652


def test_empty_warehouse_is_not_ready(warehouse):
    assert [s.status for s in build.backfill(warehouse, D1, D2)] == [build.NOT_READY] * 2
    assert warehouse.table("cdm.v_global_metrics").count() == 0


def test_late_rows_mark_their_day_for_rebuild(warehouse):
    _load(warehouse)
    build.backfill(warehouse, D1, D1)
    assert build.days_to_rebuild(warehouse) == []
    transactions, _ = staged(warehouse.spark)
    late = transactions.filter(F.col("operation_id") == uid("a8")).withColumn("operation_id", F.lit(uid("b1")))
    # Planned an hour before the build, committed after it.
    planned = late.withColumn("load_dttm", F.expr("current_timestamp() - INTERVAL 1 HOUR"))
    ingest.append_staged(warehouse, "stg.transactions", planned)
    assert build.days_to_rebuild(warehouse) == [D1]
    assert "stg/transactions/" not in str(ingest.staged_loads(warehouse).inputFiles())
    assert [s.process_date for s in build.rebuild_late(warehouse)] == [D1, D1]
    assert build.days_to_rebuild(warehouse) == build.rebuild_late(warehouse) == []
    turned = {r.amount_total for r in warehouse.table("cdm.global_metrics").filter("currency_from = 450").collect()}
    assert turned == {Decimal("0.10"), Decimal("0.12")}
