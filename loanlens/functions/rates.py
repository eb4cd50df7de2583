"""Shares and ratios as aggregate expressions (double arithmetic throughout)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tally(condition: Column) -> Column:
    """How many rows meet the condition; an unknown counts as not met."""
    return F.count(F.when(condition, F.lit(1)))


def share(condition: Column) -> Column:
    """Share of all rows that meet the condition."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)).cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Part of whole in percent, 0 when there is no whole."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits), F.lit(0.0))


def ratio_where(condition: Column, numerator: Column, denominator: Column) -> Column:
    """Sum over sum on the rows that meet the condition; null when the lower sum is 0."""
    return F.try_divide(
        F.sum(F.when(condition, numerator)).cast("double"), F.sum(F.when(condition, denominator))
    )
