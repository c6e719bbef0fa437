"""Every registered query against DuckDB, and the plans they run with."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

from tallybridge.checks.oracle import SQL
from tallybridge.checks.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Exchanges into one partition that each plan has at most: totals, bounds, a limit, and the array of the
# seven nation keys; all come behind a partial aggregate or a local limit.
SINGLE = {
    "raw_project": 1, "raw_cells": 1, "raw_dedup": 1, "raw_batch_stats": 2, "route_by_type": 1, "parse_transactions": 1,
    "parse_currencies": 1, "quarantine": 2, "top1_offset": 1, "offset_window": 1, "offset_state_advance": 2,
    "stg_latest_dates": 2, "rates_normalize": 1, "usd_rates": 1, "rates_with_usd": 1, "dim_currency_known": 1,
    "calendar_generate": 1, "calendar_increment": 1, "global_metrics": 1, "global_metrics_latest_rate": 1,
    "mart_date_bounds": 1, "calendar_x_currency": 2, "gap_filled_view": 2, "dashboard_totals": 2,
    "dashboard_slice": 2, "missing_usd_rates": 1, "ambiguous_rates": 1, "day_exists": 1, "quality_report": 1,
}
# Joins two frames of one row each.
ONE_ROW_JOIN = {"dashboard_totals"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, connection, name):
    planned = []

    def run(session, sf_dir):
        planned.append(REGISTRY[name](session, sf_dir))
        return planned[0]

    good, note, _ = compare(spark, connection, SF_DIR, run, SQL[name])
    assert good, note
    first = _plan(planned[0]).split("== Initial Plan ==")[-1]
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in first or unwanted.startswith("BroadcastNested") and name in ONE_ROW_JOIN, unwanted
    assert first.count("Exchange SinglePartition") <= SINGLE.get(name, 0), first


def test_entry_holds_every_query():
    assert set(REGISTRY) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 153


def test_messages_are_parsed_once(spark):
    plan = entry.queries()["parse_transactions"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == plan.count("Generate inline")


def test_aggregates_combine_before_every_shuffle(spark):
    plan = entry.queries()["transactions_agg"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2 and plan.count("Exchange hashpartitioning") == 3


def _children_of_shuffles(plan):
    """The operator below each hash exchange, as the plan prints it."""
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    return [lines[n + 1] for n, line in enumerate(lines) if line.startswith("Exchange hash")]


@pytest.mark.parametrize("name", ["clean_transactions", "rates_normalize", "transactions_agg"])
def test_copies_collapse_below_every_shuffle(spark, name):
    below = _children_of_shuffles(entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString())
    assert below and all("Aggregate" in child for child in below), below


def test_batch_copies_collapse_below_the_shuffle(spark):
    planned = entry.queries()["raw_dedup"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(kafka_message" in planned
