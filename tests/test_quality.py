import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loanlens.operators import quality
from loanlens.operators.cleaning import date_agreement
from loanlens.schemas import CREDIT_COLUMNS
from loanlens.sources import snapshots

A, B = dt.date(2025, 9, 30), dt.date(2025, 12, 30)


def as_of():
    return F.lit(B)


@pytest.fixture
def planted(spark):
    """Two snapshots; B has one duplicate pair, an orphan, a negative day count, a wrong date."""
    schema = "loan_id string, snapshot_date date, reporting_date date, balance double, account_status_l2 string, " \
             "next_invoice_date date, sale_date date, days_past_due bigint, days_past_due_derived bigint"
    data = [
        ("a", A, A, 1.0, "Active", A, A, 0, 0),
        ("b", A, A, 1.0, "Active", A, A, 10, 3),
        ("a", B, B, 1.0, "Active", None, B, 0, 0),
        ("b", B, B, None, "Active", B, B, -1, 30),
        ("b", B, B, 1.0, "Active", B, B, 9, 90),
        ("x", B, A, 1.0, "Active", B, B, None, 0),
    ]
    fct = spark.createDataFrame(data, schema)
    dim = spark.createDataFrame(
        [("a", dt.datetime(1990, 1, 1), 5.0), ("b", dt.datetime(1920, 1, 1), 0.0), ("c", dt.datetime(2010, 1, 1), -1.0), ("d", None, None)],
        "loan_id string, dob timestamp, received_total double",
    )
    nps = spark.createDataFrame([("a", 11.0), ("q", -1.0), ("c", 10.0), ("c", 0.0)], "loan_id string, nps_score double")
    return fct, dim, nps


def test_suite_finds_exactly_the_planted_defects(planted):
    got = {r.name: r for r in quality.run_suite(*planted, as_of(), incomplete_snapshots=0).collect()}
    assert {n: r.n_failed for n, r in got.items()} == {
        "schema_and_freshness": 1,
        "uniqueness_loan_snapshot": 2,
        "referential_integrity": 2,
        "range_checks": 2 + 2 + 2 + 1,
        "null_thresholds": 2,
        "dpd_reconciliation": 1,
    }
    assert not any(r.passed for r in got.values())
    assert json.loads(got["referential_integrity"].detail) == {"credit_not_in_customer": 1, "nps_not_in_customer": 1, "nps_not_in_credit": 2}
    assert json.loads(got["range_checks"].detail) == {"age_bounds": 2, "income_positive": 2, "nps_score_range": 2, "dpd_non_negative": 1}
    assert json.loads(got["dpd_reconciliation"].detail) == [
        {"snapshot_date": "2025-09-30", "rows": 2, "exact_match_pct": 50.0, "within_7d_pct": 100.0},
        {"snapshot_date": "2025-12-30", "rows": 4, "exact_match_pct": 33.33, "within_7d_pct": 33.33},
    ]
    routes = {r.name: r.route for r in quality.with_routes(quality.run_suite(*planted, as_of())).collect()}
    assert set(routes.values()) == {"page", "chat", "digest"}
    assert tuple(quality.gate(quality.run_suite(*planted, as_of())).first()) == (2, True)


def test_clean_data_passes_everything(planted):
    fct, dim, nps = planted
    good = fct.filter(F.col("snapshot_date") == A)
    some = dim.filter("loan_id = 'a'").unionByName(dim.filter("loan_id = 'a'").withColumn("loan_id", F.lit("b")))
    results = quality.run_suite(good, some, nps.filter("nps_score = 11").withColumn("nps_score", F.lit(5.0)), as_of(), incomplete_snapshots=0)
    assert all(r.passed and r.n_failed == 0 for r in results.collect())
    assert {r.route for r in quality.with_routes(results).collect()} == {None}
    assert tuple(quality.gate(results).first()) == (0, False)


def test_single_checks_agree_with_the_suite(planted):
    fct, dim, nps = planted
    assert rows(quality.uniqueness(fct, "loan_id")) == [(B, 2)]
    assert ("credit", "customer", "x") in rows(quality.orphans(credit=fct, customer=dim, nps=nps))
    assert {r.check: r.n_failed for r in quality.range_counts(dim, nps, fct, as_of()).collect()} == {
        "age_bounds": 2, "income_positive": 2, "nps_score_range": 2, "dpd_non_negative": 1}
    assert rows(quality.null_breaches(fct)) == [(B, "balance", "null_share", 25.0, 1.0), (B, "next_invoice_date", "null_share", 25.0, 20.0)]
    assert rows(quality.null_breaches(fct.drop("sale_date")).filter("column = 'sale_date'")) == [
        (A, "sale_date", "missing_column", 100.0, 5.0), (B, "sale_date", "missing_column", 100.0, 5.0)]
    assert [(r.snapshot_date, r.verdict) for r in quality.date_mismatches(fct).collect()] == [(B, "several dates")]
    assert rows(quality.dpd_reconciliation(fct)) == [(A, 2, 50.0, 100.0, False), (B, 4, 33.33, 33.33, True)]


def test_date_verdicts(spark):
    df = spark.createDataFrame([(A, A), (A, None), (B, A), (dt.date(2026, 1, 1), None)], "snapshot_date date, reporting_date date")
    assert {r.snapshot_date: r.verdict for r in date_agreement(df).collect()} == {
        A: "agrees", B: "other date", dt.date(2026, 1, 1): "no date"}


def test_tolerance_is_inclusive(spark):
    base = [(A, None if i == 0 else 1.0) for i in range(100)]
    limits = {"balance": 0.01}
    at = spark.createDataFrame(base, "snapshot_date date, balance double")
    over = spark.createDataFrame(base[:99], "snapshot_date date, balance double")
    assert quality.null_breaches(at, limits).count() == 0
    assert quality.null_breaches(over, limits).count() == 1


def test_contract_looks_at_the_raw_files(spark, tmp_path):
    names = [header for header, _, _ in CREDIT_COLUMNS]
    (tmp_path / "Credit_Data_-_30-09-2025.csv").write_text(",".join([*names, "MORE"]).lower() + "\n")
    few = [n for n in names if n not in ("BALANCE", "ARREARS")]
    (tmp_path / "Credit_Data_-_30-12-2025.csv").write_text(",".join(few) + "\n")
    exports = snapshots.find_snapshots(spark, f"{tmp_path}/{snapshots.FILE_GLOB}")
    found = quality.schema_contract(quality.raw_manifest(spark, snapshots.manifest(exports)))
    assert rows(found) == [("2025-12-30", "ARREARS"), ("2025-12-30", "BALANCE")]


def test_no_snapshot_is_a_failure(spark, planted):
    assert rows(quality.schema_contract(quality.raw_manifest(spark, {}))) == [(None, None)]
    fct, dim, nps = planted
    results = {r.name: r for r in quality.run_suite(fct.limit(0), dim, nps, as_of(), incomplete_snapshots=0).collect()}
    assert not results["schema_and_freshness"].passed and results["schema_and_freshness"].n_failed == 1


def test_details_are_json(planted):
    for result in quality.run_suite(*planted, as_of()).collect():
        assert isinstance(json.loads(result.detail), (dict, list)), result.name
