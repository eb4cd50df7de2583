import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanlens.functions.bands import age_at, age_band, income_band, monthly_income, nps_segment
from loanlens.functions.risk import derived_days_past_due, risk_category


@pytest.mark.parametrize(
    "age, label",
    [(-1, "Under 18"), (17, "Under 18"), (18, "18-25"), (25, "18-25"), (26, "26-35"), (35, "26-35"), (36, "36-45"),
     (45, "36-45"), (46, "46-55"), (55, "46-55"), (56, "55+"), (100, "55+"), (101, "Over 100"), (130, "Over 100"), (None, "Unknown")],
)
def test_age_band_edges(one, age, label):
    assert one("a double", [(None if age is None else float(age),)], lambda d: age_band(d.a)) == [label]


def test_age_is_whole_years_of_365_25_days(one):
    report = dt.date(2025, 12, 30)
    born = [dt.date(2007, 12, 30), dt.date(2007, 12, 29), dt.date(2000, 12, 30), None]
    got = one("b date, r date", [(b, report) for b in born], lambda d: age_at(d.b.cast("timestamp"), d.r))
    assert got == [18.0, 18.0, 24.0, None]


@pytest.mark.parametrize(
    "amount, label",
    [(-1.0, "Invalid"), (0.0, "Below 5K"), (4999.99, "Below 5K"), (4999.995, "Unknown"), (5000.0, "5K-10K"), (9999.995, "Unknown"),
     (10000.0, "10K-20K"), (20000.0, "20K-30K"), (30000.0, "30K-50K"), (50000.0, "50K-100K"), (99999.999, "Unknown"),
     (100000.0, "100K-150K"), (149999.99, "100K-150K"), (150000.0, "150K+"), (1e12, "150K+"), (None, "Unknown")],
)
def test_income_band_edges(one, amount, label):
    assert one("m double", [(amount,)], lambda d: income_band(d.m)) == [label]


def test_monthly_income_needs_a_positive_duration(one):
    got = one("r double, m double", [(120.0, 12.0), (120.0, 0.0), (120.0, None), (120.0, -1.0), (None, 3.0)],
              lambda d: monthly_income(d.r, d.m))
    assert got == [10.0, None, None, None, None]


def test_nps_segments(one):
    scores = [0.0, 6.0, 7.0, 8.0, 8.5, 9.0, 10.0, 11.0, -1.0]
    got = one("s double", [(s,) for s in scores], lambda d: nps_segment(d.s))
    assert got == ["Detractor", "Detractor", "Passive", "Passive", "Passive", "Promoter", "Promoter", "Promoter", "Detractor"]


@pytest.mark.parametrize(
    "l1, l2, days, expected",
    [
        ("Write Off", "Active", 0, "Critical"),
        ("Lost Write Off", "Paid Off", 0, "Critical"),
        ("Existing Active", "Return", 95, "Critical"),
        ("Existing Active", "Active", 90, "Critical"),
        ("Existing Active", "Return", 5, "Returned"),
        ("Cancelled Returned in 3 mths", "Paid Off", 0, "Returned"),
        ("First 2 days Return", "Active", 0, "Returned"),
        ("Return", None, 0, "Returned"),
        ("Existing Active", "Paid Off", 45, "Closed"),
        ("Existing Active", "Active", 89, "High"),
        ("Existing Active", "Active", 31, "High"),
        ("Existing Active", "PAR 30", 0, "High"),
        ("Existing Active", "FMD", 0, "High"),
        ("Existing Active", "Active", 30, "Medium"),
        ("Existing Active", "Active", 1, "Medium"),
        ("Existing Active", "PAR 7", 0, "Medium"),
        ("Existing Active", "FPD", 0, "Medium"),
        ("Existing Active", "Inactive", 0, "Medium"),
        ("Existing Active", "Active", 0, "Low"),
        ("Existing Active", "Active", None, "Low"),
        (None, "Active", 0, "Low"),
        (None, None, None, "Unclassified"),
        ("Existing Active", "Unknown", 0, "Unclassified"),
        ("Existing Active", "Active", -1, "Unclassified"),
    ],
)
def test_risk_precedence(one, l1, l2, days, expected):
    assert one("a string, b string, d int", [(l1, l2, days)], lambda d: risk_category(d.a, d.b, d.d)) == [expected]


def test_unreadable_days_count_as_zero(one):
    got = one("a string, b string, d string", [("x", "Active", "?"), ("x", "Active", "95.0")],
              lambda d: risk_category(d.a, d.b, d.d))
    assert got == ["Low", "Critical"]


def test_derived_days(one):
    a, b = dt.date(2025, 3, 30), dt.date(2025, 3, 20)
    cases = [(a, b, 1.0, 10), (a, b, 0.0, 0), (b, a, 1.0, 0), (a, None, 1.0, 0), (None, b, 1.0, 0), (a, b, None, 0), (a, a, 1.0, 0)]
    got = one("r date, i date, a double", [c[:3] for c in cases], lambda d: derived_days_past_due(d.r, d.i, d.a))
    assert got == [c[3] for c in cases]
    assert all(v is not None for v in got)


def test_shares_keep_full_precision(spark):
    from loanlens.functions.rates import share

    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert df.agg(share(F.col("x") > 1)).first()[0] == 2 / 3
