"""Age, income and survey-score bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.values import full_days

UNKNOWN = "Unknown"

# Inclusive age bounds per label, with the two out-of-range labels.
AGE_BANDS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, 120, "55+")]
YOUNGEST, OLDEST = 18, 100
UNDER_AGE, OVER_AGE = "Under 18", "Over 100"

# Inclusive income bounds per label.  The gaps of a cent between the
# bands are part of the contract: such an amount is 'Unknown'.
INCOME_BANDS = [
    (0.0, 4999.99, "Below 5K"),
    (5000.0, 9999.99, "5K-10K"),
    (10000.0, 19999.99, "10K-20K"),
    (20000.0, 29999.99, "20K-30K"),
    (30000.0, 49999.99, "30K-50K"),
    (50000.0, 99999.99, "50K-100K"),
    (100000.0, 149999.99, "100K-150K"),
    (150000.0, float("inf"), "150K+"),
]
INVALID_INCOME = "Invalid"

# Lowest score of the two upper survey segments.
PROMOTER_FROM, PASSIVE_FROM = 9, 7


def _labelled(value: Column, bands: list[tuple], first: list[tuple[Column, str]]) -> Column:
    """Label of the first matching rule: special cases, then closed intervals."""
    rules = first + [(value.between(low, high), label) for low, high, label in bands]
    (head, label), *rest = rules
    return reduce(lambda chain, rule: chain.when(*rule), rest, F.when(head, label)).otherwise(UNKNOWN)


def age_at(dob: Column, reference: Column) -> Column:
    """Completed years of 365.25 days at the reference date."""
    return F.floor(full_days(dob, reference) / F.lit(365.25)).cast("double")


def age_band(age: Column) -> Column:
    return _labelled(age, AGE_BANDS, [(age < YOUNGEST, UNDER_AGE), (age > OLDEST, OVER_AGE)])


def monthly_income(received: Column, months: Column) -> Column:
    """Received total per month; null without a positive duration."""
    return F.when(months > 0, received / months)


def income_band(monthly: Column) -> Column:
    return _labelled(monthly, INCOME_BANDS, [(monthly < 0, INVALID_INCOME)])


def nps_segment(score: Column) -> Column:
    return (
        F.when(score >= PROMOTER_FROM, "Promoter").when(score >= PASSIVE_FROM, "Passive").otherwise("Detractor")
    )
