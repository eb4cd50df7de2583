"""Metrics kept as mergeable state: sums and counts per snapshot, rates derived when asked for.

The state of a snapshot is a few rows, stored in its own partition.  A new snapshot adds its
partition and a rerun replaces it; no other snapshot is read again.  States add up, so a
snapshot may also come in parts that are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.rates import tally
from loanlens.functions.risk import PAID_OFF_STATUS, is_write_off
from loanlens.operators.metrics import book
from loanlens.sources.tables import write_partitions

AT = "snapshot_date"


def portfolio_state(fct: DataFrame, *dims: str) -> DataFrame:
    """Sums and counts of the book per snapshot and combination of ``dims``."""
    paying = F.col("account_status_l2") != PAID_OFF_STATUS
    sums = {"balance": F.col("balance"), "arrears": F.col("arrears"), "paid": F.col("total_paid"), "due": F.col("total_due_today"),
            "paid_active": F.when(paying, F.col("total_paid")), "due_active": F.when(paying, F.col("total_due_today"))}
    counts = {"n_delinquent": F.col("days_past_due") > 0, "n_par90": F.col("days_past_due") >= 90,
              "n_write_off": is_write_off(F.col("account_status_l1")), "n_paid_off": F.col("account_status_l2") == PAID_OFF_STATUS}
    return book(fct).groupBy(AT, *dims).agg(
        F.count(F.lit(1)).alias("n_loans"),
        *[tally(condition).alias(name) for name, condition in counts.items()],
        *[F.sum(value).alias(f"sum_{name}") for name, value in sums.items()],
    )


def merged(states: DataFrame, *dims: str) -> DataFrame:
    """States of the same snapshot and segments added up."""
    return states.groupBy(AT, *dims).agg(*[F.sum(c).alias(c) for c in states.columns if c.startswith(("n_", "sum_"))])


def keep(state: DataFrame, path: str) -> None:
    """Store the state of the snapshots in it; those of others stay as they are."""
    write_partitions(state, path, by=AT, rebalance=False)


def _rate(count: str) -> Column:
    return F.col(count) / F.col("n_loans")


def portfolio_kpis(states: DataFrame) -> DataFrame:
    """The metrics of ``metrics.portfolio_kpis`` from stored states of any segments."""
    return merged(states).select(
        AT, F.col("n_loans").alias("active_loans"), F.col("sum_balance").alias("total_outstanding"), F.col("sum_arrears").alias("total_arrears"),
        F.col("sum_paid").alias("total_paid_cum"), F.col("sum_due").alias("total_due_cum"),
        _rate("n_delinquent").alias("delinquency_rate"), _rate("n_par90").alias("par90_rate"), _rate("n_write_off").alias("write_off_rate"),
        _rate("n_paid_off").alias("paid_off_rate"), F.try_divide("sum_paid_active", "sum_due_active").alias("collection_rate_active"),
    )


def segment_kpis(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The rates of ``metrics.segment_kpis`` from stored states by all of ``dims``."""
    sides = F.array(*[F.struct(F.lit(d).alias("segment_dim"), F.col(d).alias("segment")) for d in dims])
    counts = [c for c in states.columns if c.startswith("n_")]
    cells = merged(states.select(AT, F.inline(sides), *counts), "segment_dim", "segment")
    return cells.select(
        AT, "segment_dim", "segment", "n_loans", _rate("n_delinquent").alias("delinquency_rate"),
        _rate("n_par90").alias("par90_rate"), _rate("n_write_off").alias("write_off_rate"),
    )
