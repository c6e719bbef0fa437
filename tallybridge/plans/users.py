"""Bitmaps of the senders behind the mart, kept by day like the mart itself."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import senders as S
from ..operators.cleaning import done_only
from ..operators.reports import dashboard_slice
from .partitions import replace_days
from .warehouse import Warehouse


def senders_of(warehouse: Warehouse, days: Sequence[date]) -> DataFrame:
    """(date_update, currency_from, account_number_from) of completed transactions, each once."""
    clean = warehouse.table("dds.transactions").filter(F.col("p_date").isin(*days))
    named = done_only(clean).select(F.col("p_date").alias("date_update"), F.col("currency_code").alias("currency_from"), "account_number_from")
    return named.distinct()


def number_accounts(warehouse: Warehouse, senders: DataFrame) -> int:
    """Give accounts that have no number yet the next ones; how many there are then. One run at a time."""
    known = warehouse.table("dds.dim_account")
    highest = known.agg(F.max("account_id")).first()[0]
    start = 1 if highest is None else highest + 1
    seen = senders.select(F.col("account_number_from").alias("account_number"))

    def write(df: DataFrame) -> DataFrame:
        folder = warehouse.fresh_location("dds.dim_account")
        df.write.parquet(folder)
        return warehouse.spark.read.schema(df.schema).parquet(folder)

    warehouse.append("dds.dim_account", S.numbered(S.new_accounts(seen, known), start, write))
    return warehouse.table("dds.dim_account").count()


def build_bits(warehouse: Warehouse, days: Sequence[date], senders: DataFrame | None = None) -> set[date]:
    """Replace the bitmaps of ``days``; ``senders`` come from the transactions if not given."""
    if not days:
        return set()
    folder = warehouse.fresh_location("cdm.senders")
    found = senders if senders is not None else senders_of(warehouse, days)
    found.write.parquet(folder)
    found = warehouse.spark.read.schema(found.schema).parquet(folder)
    number_accounts(warehouse, found)
    bits = S.sender_bits(found, warehouse.table("dds.dim_account"))
    return replace_days(warehouse, "cdm.sender_bits", bits.withColumn("p_date", F.col("date_update")), days)


def dashboard(
    warehouse: Warehouse, first: date, last: date, currencies: Sequence[int] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Volume, transactions and unique users of a slice, from the mart and its bitmaps; no transaction is read."""
    inside = F.col("p_date").between(F.lit(first), F.lit(last))
    mart, bits = (
        dashboard_slice(warehouse.table(t).filter(inside), first, last, currencies) for t in ("cdm.global_metrics", "cdm.sender_bits")
    )
    return S.dashboard_from_bits(mart, bits, by)
