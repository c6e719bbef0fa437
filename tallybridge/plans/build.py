"""Building days: STG -> DDS -> CDM, for one date or a whole range in one job per table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.days import day_slice
from ..functions.timestamps import load_moment
from ..operators import cleaning, dimensions, metrics, quality
from ..schemas import ALL_RATES, BACKFILL_JOURNAL, BASE_CURRENCY, MART_BOUNDS, STAGED_LOADS
from .concurrent import side_by_side
from .ingest import staged_loads
from .partitions import days_between, point_partitions, replace_days
from .warehouse import Warehouse

BUILT, FAILED, SKIPPED, NOT_READY = "built", "failed", "skipped", "not ready"


class QualityError(ValueError):
    """A check found days that are incomplete."""


@dataclass(frozen=True)
class DayStatus:
    layer: str
    process_date: date
    status: str
    reason: str = ""


def _now(warehouse: Warehouse) -> Column:
    """This moment as a literal."""
    text = warehouse.spark.range(1).select(load_moment().cast("string")).first()[0]
    return F.lit(text).cast("timestamp")


def _log(warehouse: Warehouse, statuses: Sequence[DayStatus], started: Column) -> None:
    """Record a build under the moment it began, so rows staged while it ran count as late."""
    if statuses:
        rows = [(s.layer, s.process_date, s.status) for s in statuses]
        frame = warehouse.spark.createDataFrame(rows, "layer string, process_date date, status string")
        warehouse.append("dds.build_log", frame.withColumn("load_dttm", started))


def _day_frame(warehouse: Warehouse, days: Sequence[date], name: str) -> DataFrame:
    return warehouse.spark.createDataFrame([(d,) for d in days], f"{name} date")


def readiness(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    """The gate per day, from the days that the catalog lists for both staged tables."""
    moved, quoted = (
        _day_frame(warehouse, sorted(warehouse.days(t)), "p_date") for t in ("stg.transactions", "stg.currencies")
    )
    return quality.day_readiness(_day_frame(warehouse, days, "process_date"), moved, quoted)


def ready_days(warehouse: Warehouse, days: Sequence[date]) -> list[date]:
    """Days that both staged tables have moved past."""
    return sorted(r.process_date for r in readiness(warehouse, days).filter("ready").collect()) if days else []


def _slice(df: DataFrame, moment: str, days: Sequence[date]) -> DataFrame:
    """Rows of the given days; the closed range prunes, the list narrows it where there are holes."""
    rows = day_slice(df, moment, min(days), max(days))
    holes = len(set(days)) < (max(days) - min(days)).days + 1
    return rows.filter(F.col("p_date").isin(*days)) if holes else rows


def _note_loads(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    """The staging loads of ``days`` that are committed by now, written down before STG is read."""
    folder = warehouse.fresh_location("dds.build_loads")
    loads = staged_loads(warehouse).filter(F.col("process_date").isin(*days))
    loads.distinct().coalesce(1).write.parquet(folder)
    return warehouse.spark.read.schema(STAGED_LOADS).parquet(folder)


def build_dds(warehouse: Warehouse, days: Sequence[date], rate_policy: str = ALL_RATES) -> list[DayStatus]:
    """Rebuild transactions and rates of ``days``, extend the currency dimension, check both.

    Each table is one job over all days, not one per day. Days without transactions or
    without rates count as failed; the others are built all the same.
    """
    if not days:
        return []
    started, seen = _now(warehouse), _note_loads(warehouse, days)

    def transactions() -> set[date]:
        staged = _slice(warehouse.table("stg.transactions"), "transaction_dt", days)
        held = replace_days(warehouse, "dds.transactions", cleaning.clean_transactions(staged), days)
        clean = warehouse.table("dds.transactions").filter(F.col("p_date").isin(*days))
        warehouse.append("dds.dim_currency", dimensions.new_currencies(clean, warehouse.table("dds.dim_currency")))
        return held

    def rates() -> set[date]:
        quoted = cleaning.normalize_rates(_slice(warehouse.table("stg.currencies"), "date_update", days), rate_policy)
        return replace_days(warehouse, "dds.currencies", quoted.withColumn("p_date", F.col("rate_date")), days)

    moved, rated = side_by_side(warehouse.spark, transactions, rates)
    statuses = []
    for day in days:
        gaps = [text for text, present in (("no transactions", day in moved), ("no rates", day in rated)) if not present]
        statuses.append(DayStatus("dds", day, FAILED if gaps else BUILT, ", ".join(gaps)))
    warehouse.append("dds.build_loads", seen)
    _log(warehouse, statuses, started)
    return statuses


def _rates(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    return warehouse.table("dds.currencies").filter(F.col("p_date").isin(*days))


def _turnover(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    """Turnover per day and currency, written once: mart and missing rates both come from it."""
    clean = warehouse.table("dds.transactions").filter(F.col("p_date").isin(*days))
    folder, turnovers = warehouse.fresh_location("cdm.turnover"), metrics.turnover(clean)
    turnovers.write.parquet(folder)
    return warehouse.spark.read.schema(turnovers.schema).parquet(folder)


def build_mart(
    warehouse: Warehouse, upstream: Sequence[DayStatus], base: int = BASE_CURRENCY, gate: str = "after"
) -> list[DayStatus]:
    """Rebuild the mart for the days whose upstream build succeeded and check their rates.

    Other days are skipped. With ``gate="after"`` a day with missing rates is published
    without those currencies and reported as failed; ``"before"`` holds it back instead.
    The currencies without a rate stay in ``cdm.missing_rates``; the driver gets a count per day.
    """
    return publish_mart(warehouse, upstream, lambda days: _turnover(warehouse, days), base, gate)


def publish_mart(
    warehouse: Warehouse,
    upstream: Sequence[DayStatus],
    turnover_of: Callable[[Sequence[date]], DataFrame],
    base: int = BASE_CURRENCY,
    gate: str = "after",
) -> list[DayStatus]:
    """The same from any source of turnovers, called with the days to build."""
    if gate not in ("after", "before"):
        raise ValueError(f"unknown gate: {gate}")
    started = _now(warehouse)
    skipped = [DayStatus("cdm", s.process_date, SKIPPED, s.reason) for s in upstream if s.status != BUILT]
    days = [s.process_date for s in upstream if s.status == BUILT]
    unrated: dict[date, str] = {}
    if days:
        turnovers, rates = turnover_of(days), _rates(warehouse, days)
        missing = quality.unrated(turnovers, rates, base).withColumn("p_date", F.col("process_date"))

        def publish(chosen: Sequence[date]) -> None:
            if chosen:
                rated = cleaning.rates_with_base(rates, _day_frame(warehouse, chosen, "rate_date"), base)
                mart = metrics.to_base_currency(turnovers, rated).withColumn("p_date", F.col("date_update"))
                replace_days(warehouse, "cdm.global_metrics", mart, chosen)
                _note_bounds(warehouse)

        def check() -> dict[date, str]:
            replace_days(warehouse, "cdm.missing_rates", missing, days)
            stored = warehouse.table("cdm.missing_rates").filter(F.col("p_date").isin(*days))
            return _counted(stored)

        if gate == "before":
            unrated = check()
            publish([d for d in days if d not in unrated])
        else:
            _, unrated = side_by_side(warehouse.spark, lambda: publish(days), check)
    built = [
        DayStatus("cdm", d, FAILED, f"missing rates: {unrated[d]}") if d in unrated else DayStatus("cdm", d, BUILT)
        for d in days
    ]
    statuses = sorted(skipped + built, key=lambda s: s.process_date)
    _log(warehouse, statuses, started)
    return statuses


def _note_bounds(warehouse: Warehouse) -> None:
    """Leave the first and last day of the mart, which the catalog knows, for its readers."""
    held = warehouse.days("cdm.global_metrics")
    folder = warehouse.fresh_location("cdm.mart_bounds")
    bounds = [(min(held, default=None), max(held, default=None))]
    warehouse.spark.createDataFrame(bounds, MART_BOUNDS).coalesce(1).write.parquet(folder)
    point_partitions(warehouse, "cdm.mart_bounds", {"part=all": folder})


def _counted(missing: DataFrame) -> dict[date, str]:
    """Per day how many currencies lack a rate, and the lowest and highest of them."""
    found = missing.groupBy("process_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("currency_from").alias("lowest"), F.max("currency_from").alias("highest")
    )
    return {r.process_date: f"{r.n} from {r.lowest} to {r.highest}" for r in found.collect()}


def backfill(
    warehouse: Warehouse, first: date, last: date, base: int = BASE_CURRENCY, rate_policy: str = ALL_RATES
) -> list[DayStatus]:
    """Build every ready day of the closed range through to the mart; same result as day by day."""
    wanted = days_between(first, last)
    days = ready_days(warehouse, wanted)
    ready = set(days)
    waiting = [DayStatus("dds", d, NOT_READY) for d in wanted if d not in ready]
    below = build_dds(warehouse, days, rate_policy)
    return below + build_mart(warehouse, below, base) + waiting


def resume_backfill(
    warehouse: Warehouse,
    name: str,
    first: date,
    last: date,
    chunk: int = 31,
    most_chunks: int | None = None,
    base: int = BASE_CURRENCY,
    rate_policy: str = ALL_RATES,
) -> list[DayStatus]:
    """Backfill in chunks of days under a ``name``, and go on where a run of that name ended.

    What a chunk has finished is noted day by day, first its DDS build, then its mart. A run that
    finds notes repeats none of that work: built days are not built again, a chunk that was
    killed before its mart goes on with it. Days that were not ready are tried again. ``most_chunks`` paces
    a run. Gives the status of all noted days and of those not ready.
    """
    noted = warehouse.table("dds.backfill_journal").filter(F.col("backfill") == name)
    # Two rows a day.
    rows = noted.select("layer", "process_date", "status", "reason").collect()
    done = {(r.layer, r.process_date): DayStatus(*r) for r in rows}
    waiting: list[DayStatus] = []

    def note(found: Sequence[DayStatus]) -> None:
        frame = [(name, s.layer, s.process_date, s.status, s.reason) for s in found]
        warehouse.append("dds.backfill_journal", warehouse.spark.createDataFrame(frame, BACKFILL_JOURNAL).coalesce(1))
        done.update({(s.layer, s.process_date): s for s in found})

    days, worked = days_between(first, last), 0
    for start in range(0, len(days), chunk):
        wanted = days[start : start + chunk]
        if most_chunks is not None and worked >= most_chunks:
            break
        unbuilt = [d for d in wanted if ("dds", d) not in done]
        ready = ready_days(warehouse, unbuilt)
        waiting += [DayStatus("dds", d, NOT_READY) for d in unbuilt if d not in set(ready)]
        if ready:
            note(build_dds(warehouse, ready, rate_policy))
        upstream = [done["dds", d] for d in wanted if ("dds", d) in done and ("cdm", d) not in done]
        if upstream:
            note(build_mart(warehouse, upstream, base))
        worked += bool(ready or upstream)
    return sorted(done.values(), key=lambda s: (s.layer != "dds", s.process_date)) + waiting


def build_day(warehouse: Warehouse, day: date, base: int = BASE_CURRENCY) -> list[DayStatus]:
    return backfill(warehouse, day, day, base)


def days_to_rebuild(warehouse: Warehouse) -> list[date]:
    """Built days with staged loads that none of their builds saw; only the logs are read."""
    built = warehouse.table("dds.build_log").filter("layer = 'dds'").select("process_date").distinct()
    late = quality.late_days(staged_loads(warehouse), warehouse.table("dds.build_loads"))
    return sorted(row.process_date for row in late.join(built, "process_date", "left_semi").collect())


def rebuild_late(warehouse: Warehouse, base: int = BASE_CURRENCY, rate_policy: str = ALL_RATES) -> list[DayStatus]:
    """Rebuild, from DDS to the mart, the days that gained rows."""
    below = build_dds(warehouse, days_to_rebuild(warehouse), rate_policy)
    return below + build_mart(warehouse, below, base)


def require(statuses: Sequence[DayStatus]) -> None:
    """Raise if any day failed its checks."""
    failed = [s for s in statuses if s.status == FAILED]
    if failed:
        raise QualityError("; ".join(f"{s.layer} {s.process_date}: {s.reason}" for s in failed))


def require_transactions(warehouse: Warehouse, day: date) -> None:
    if not quality.holds_day(warehouse.table("dds.transactions"), "p_date", day):
        raise QualityError(f"no transactions on {day}")


def require_rates(warehouse: Warehouse, day: date) -> None:
    if not quality.holds_day(warehouse.table("dds.currencies"), "p_date", day):
        raise QualityError(f"no rates on {day}")


def require_base_rates(warehouse: Warehouse, day: date, base: int = BASE_CURRENCY) -> None:
    clean = warehouse.table("dds.transactions").filter(F.col("p_date") == F.lit(day))
    missing = _counted(quality.missing_rates(clean, _rates(warehouse, [day]), base))
    if missing:
        raise QualityError(f"no base rate on {day} for {missing[day]}")
