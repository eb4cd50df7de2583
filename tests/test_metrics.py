import datetime as dt
from collections import defaultdict

import pytest
from conftest import SMALL, day, rows
from pyspark.sql import functions as F

from loanlens.operators import metrics
from loanlens.plans import marts
from loanlens.registry import adapters

FACT = "snapshot_date date, loan_id string, balance double, arrears double, total_paid double, total_due_today double, " \
       "days_past_due bigint, account_status_l1 string, account_status_l2 string, risk_category string, age_band string"
OLD, NEW = dt.date(2025, 9, 30), dt.date(2025, 12, 30)


def loan(date, key, days=0, l1="Existing Active", l2="Active", risk="Low", band="18-25", balance=100.0, paid=10.0, due=20.0):
    return (date, key, balance, 1.0, paid, due, days, l1, l2, risk, band)


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([
        loan(OLD, "a"),
        loan(OLD, "b", days=95, l1="Write Off", risk="Critical"),
        loan(OLD, "c", risk="Returned"),
        loan(NEW, "a", days=3, risk="Medium", band=None, balance=300.0),
        loan(NEW, "b", l2="Paid Off", risk="Closed", paid=99.0),
        loan(NEW, "d", l2=None, risk="Unclassified", paid=50.0),
        loan(NEW, "c", risk="Returned", balance=999.0),
    ], FACT)


def test_portfolio_kpis(fact):
    old, new = (r.asDict() for r in metrics.portfolio_kpis(fact).collect())
    assert (old["active_loans"], old["delinquency_rate"], old["par90_rate"], old["write_off_rate"]) == (2, 0.5, 0.5, 0.5)
    assert new["active_loans"] == 3 and new["total_outstanding"] == 500.0
    assert new["delinquency_rate"] == 1 / 3 and new["paid_off_rate"] == 1 / 3
    # The paid-off loan and the one without a status count on neither side.
    assert new["collection_rate_active"] == 0.5


def test_nothing_due_gives_no_rate(spark):
    df = spark.createDataFrame([loan(OLD, "a", due=0.0)], FACT)
    assert metrics.portfolio_kpis(df).first().collection_rate_active is None


def test_growth(fact):
    got = {r.measure: (r["first"], r.latest, r.ratio) for r in metrics.portfolio_growth(metrics.portfolio_kpis(fact)).collect()}
    assert got == {"active_loans": (2.0, 3.0, 1.5), "total_outstanding": (200.0, 500.0, 2.5)}


def test_unknown_and_unmatched_segments_stay_apart(spark, fact):
    dim = spark.createDataFrame([("a", "Unknown"), ("b", "5K-10K")], "loan_id string, avg_monthly_income_band string")
    base = metrics.segment_base(fact, dim, income_band="avg_monthly_income_band")
    got = [(r.segment, r.n_loans) for r in metrics.segment_kpis(base, "income_band").filter(F.col("snapshot_date") == NEW).collect()]
    assert got == [("5K-10K", 1), ("Unknown", 1), (None, 1)]


def test_a_null_segment_is_no_roll_up(spark, fact):
    both = metrics.segment_kpis(metrics.book(fact).withColumn("income_band", F.lit("x")), "age_band", "income_band")
    got = rows(both.filter(F.col("snapshot_date") == NEW).select("segment_dim", "segment", "n_loans"))
    assert got == [("age_band", "18-25", 2), ("age_band", None, 1), ("income_band", "x", 3)]


def test_segments_add_up_to_the_portfolio(spark):
    fct, dim = adapters.credit_fact(spark, SMALL), adapters.customer_dimension(spark, SMALL)
    book = {r.snapshot_date: r for r in metrics.portfolio_kpis(fct).collect()}
    base = metrics.segment_base(fct, dim, income_band="avg_monthly_income_band")
    loans, late = defaultdict(int), defaultdict(float)
    for r in metrics.segment_kpis(base, "age_band", "income_band").collect():
        loans[r.snapshot_date, r.segment_dim] += r.n_loans
        late[r.snapshot_date, r.segment_dim] += r.n_loans * r.delinquency_rate
    assert len(loans) == 2 * len(book)
    for (date, _), n in loans.items():
        assert n == book[date].active_loans
    for (date, dim_name), n in late.items():
        assert n / loans[date, dim_name] == pytest.approx(book[date].delinquency_rate, abs=1e-9)


def test_divergent_segments_need_enough_loans(spark):
    data = [loan(NEW, f"a{i}", days=1, band="18-25") for i in range(200)]
    data += [loan(NEW, f"b{i}", days=1, band="26-35") for i in range(199)]
    data += [loan(NEW, f"c{i}", band="36-45") for i in range(400)] + [loan(OLD, f"d{i}", band="46-55") for i in range(300)]
    got = metrics.divergent_segments(spark.createDataFrame(data, FACT), "age_band").collect()
    assert [(r.segment, r.n_loans) for r in got] == [("18-25", 200), ("36-45", 400)]
    share = 399 / 799
    assert got[0].delta_vs_portfolio == pytest.approx(1 - share) and got[1].delta_vs_portfolio == pytest.approx(-share)


def test_top_exposures_take_the_newest_snapshot(spark, fact):
    dim = spark.createDataFrame([("a", "F"), ("z", "M")], "loan_id string, gender string")
    top = metrics.latest_top_exposures(fact, dim, ["gender"], keep=["loan_id", "snapshot_date", "balance"], k=3)
    assert [(r.loan_id, r.balance, r.gender) for r in top.collect()] == [("c", 999.0, None), ("a", 300.0, "F"), ("b", 100.0, None)]


def test_survey_uses_the_newest_state(spark, fact):
    survey = spark.createDataFrame(
        [("a", 9.0, "Promoter", "Yes", "No"), ("a", 3.0, "Detractor", "No", "No"), ("b", 8.0, "Passive", "Yes", "Yes"), ("q", 9.0, "Promoter", "No", "No")],
        "loan_id string, nps_score double, nps_segment string, phone_locked_despite_payment string, experienced_payment_delay string",
    )
    got = {r.risk_category: r for r in metrics.nps_by_risk(metrics.survey_with_credit(survey, fact)).collect()}
    assert set(got) == {"Medium", "Closed"}
    assert (got["Medium"].n_responses, got["Medium"].mean_nps, got["Medium"].net_promoter_score) == (2, 6.0, 0.0)
    assert got["Medium"].pct_locked_after_paying == 0.5 and got["Closed"].pct_payment_delay == 1.0
    for r in got.values():
        assert r.net_promoter_score == pytest.approx(100 * (r.promoter_rate - r.detractor_rate))


def test_snapshot_counts(fact):
    assert rows(metrics.snapshot_counts(fact)) == [(OLD, 3, 3), (NEW, 4, 4)]


def test_fact_keeps_loans_without_customer(spark):
    credit = spark.createDataFrame(
        [("a", day("2025-12-30"), day("2025-12-01"), 5.0, 7, "Existing Active", "Active"), ("b", day("2025-12-30"), None, 5.0, 0, "x", None)],
        "loan_id string, reporting_date date, next_invoice_date date, arrears double, days_past_due bigint, account_status_l1 string, account_status_l2 string",
    )
    customer = spark.createDataFrame([("a", dt.datetime(1990, 1, 1))], "loan_id string, dob timestamp")
    got = rows(marts.fct_credit_snapshot(credit, customer).select("loan_id", "age_at_report", "age_band", "days_past_due_derived", "risk_category"))
    assert got == [("a", 35.0, "26-35", 29, "Medium"), ("b", None, "Unknown", 0, "Unclassified")]
