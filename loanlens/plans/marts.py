"""Staged tables to the customer dimension and the credit fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.bands import age_at, age_band, income_band, monthly_income
from loanlens.functions.risk import derived_days_past_due, risk_category


def dim_customer(customer: DataFrame) -> DataFrame:
    """Staged customers with monthly income and its band (the same at every snapshot)."""
    return customer.withColumn(
        "avg_monthly_income", monthly_income(F.col("received_total"), F.col("duration_months"))
    ).withColumn("avg_monthly_income_band", income_band(F.col("avg_monthly_income")))


def with_dob(credit: DataFrame, customer: DataFrame, on: str = "loan_id") -> DataFrame:
    return credit.join(customer.select(on, "dob"), on, "left")


def with_features(credit: DataFrame) -> DataFrame:
    """Age, derived days past due and risk class as plain expressions, no shuffle."""
    return credit.withColumns(
        {
            "age_at_report": age_at(F.col("dob"), F.col("reporting_date")),
            "days_past_due_derived": derived_days_past_due(
                F.col("reporting_date"), F.col("next_invoice_date"), F.col("arrears")
            ),
            "risk_category": risk_category(
                F.col("account_status_l1"), F.col("account_status_l2"), F.col("days_past_due")
            ),
        }
    ).withColumn("age_band", age_band(F.col("age_at_report")))


def fct_credit_snapshot(credit: DataFrame, customer: DataFrame, on: str = "loan_id") -> DataFrame:
    """Loan by snapshot with features; the join with the dates of birth is the one shuffle."""
    return with_features(with_dob(credit, customer, on))
