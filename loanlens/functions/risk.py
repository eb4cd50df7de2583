"""Arrears age and the risk class of a loan in one snapshot."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.values import full_days

# Account status texts with a meaning for the risk class.
WRITE_OFF_STATUSES = ["Write Off", "Lost Write Off"]
RETURN_PREFIXES = ["Cancelled Returned", "First 2 days Return", "Return"]
RETURN_STATUS = "Return"
PAID_OFF_STATUS = "Paid Off"
HIGH_STATUSES = ["PAR 30", "FMD"]
MEDIUM_STATUSES = ["PAR 7", "FPD", "Inactive"]
LOW_STATUS = "Active"

RETURNED = "Returned"


def is_write_off(status_l1: Column) -> Column:
    return status_l1.isin(WRITE_OFF_STATUSES)


def is_returned(status_l1: Column, status_l2: Column) -> Column:
    return reduce(or_, [status_l1.startswith(p) for p in RETURN_PREFIXES], status_l2 == RETURN_STATUS)


def derived_days_past_due(reporting: Column, next_invoice: Column, arrears: Column) -> Column:
    """Days from the invoice to the report for a loan in arrears, else 0 (never null)."""
    days = full_days(next_invoice, reporting)
    return F.when((arrears > 0) & (days > 0), days).otherwise(F.lit(0)).cast("bigint")


def risk_category(status_l1: Column, status_l2: Column, days_past_due: Column) -> Column:
    """Seven classes; the first rule that holds wins and an unknown never holds.

    A written-off or 90-day loan is Critical even when it was returned or paid off.  A
    status text outside the lists leaves the loan Unclassified unless its days decide.
    """
    days = F.coalesce(days_past_due.try_cast("double"), F.lit(0.0))
    return (
        F.when(is_write_off(status_l1) | (days >= 90), "Critical")
        .when(is_returned(status_l1, status_l2), RETURNED)
        .when(status_l2 == PAID_OFF_STATUS, "Closed")
        .when(days.between(31, 89) | status_l2.isin(HIGH_STATUSES), "High")
        .when(days.between(1, 30) | status_l2.isin(MEDIUM_STATUSES), "Medium")
        .when((days == 0) & (status_l2 == LOW_STATUS), "Low")
        .otherwise("Unclassified")
    )
