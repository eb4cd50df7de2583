"""Derived features, the customer dimension and the credit fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.functions import bands, risk
from loanlens.plans import marts
from loanlens.registry import adapters as a
from loanlens.registry.adapters import sql_day, sql_round, using
from loanlens.registry.core import query, rounded

KEYS = ("loan_id", "line_no", "snapshot_date")
SQL_KEYS = f"loan_id, line_no, {sql_day('snapshot_date')} AS snapshot_date"


@query("fea_age", using("fct") + f"SELECT {SQL_KEYS}, age_at_report FROM fct")
def fea_age(spark, sf):
    rows = marts.with_dob(a.loan_snapshot(spark, sf), a.loan_customer(spark, sf))
    return rows.select(*KEYS, bands.age_at(F.col("dob"), F.col("reporting_date")).alias("age_at_report"))


@query("fea_age_band", using("fct") + f"SELECT {SQL_KEYS}, age_band FROM fct")
def fea_age_band(spark, sf):
    rows = marts.with_dob(a.loan_snapshot(spark, sf), a.loan_customer(spark, sf))
    return rows.select(*KEYS, bands.age_band(bands.age_at(F.col("dob"), F.col("reporting_date"))).alias("age_band"))


@query("fea_monthly_income", using("dim") + f"SELECT loan_id, {sql_round('avg_monthly_income', 6)} AS avg_monthly_income FROM dim")
def fea_monthly_income(spark, sf):
    income = bands.monthly_income(F.col("received_total"), F.col("duration_months"))
    return rounded(a.loan_customer(spark, sf).select("loan_id", income.alias("avg_monthly_income")), 6, "avg_monthly_income")


@query("fea_income_band", using("dim") + "SELECT avg_monthly_income_band, count(*) AS n FROM dim GROUP BY avg_monthly_income_band")
def fea_income_band(spark, sf):
    income = bands.monthly_income(F.col("received_total"), F.col("duration_months"))
    labelled = a.loan_customer(spark, sf).select(bands.income_band(income).alias("avg_monthly_income_band"))
    return labelled.groupBy("avg_monthly_income_band").agg(F.count(F.lit(1)).alias("n"))


@query("fea_dpd_derived", using("risk") + f"SELECT {SQL_KEYS}, days_past_due_derived FROM risk")
def fea_dpd_derived(spark, sf):
    days = risk.derived_days_past_due(F.col("reporting_date"), F.col("next_invoice_date"), F.col("arrears"))
    return a.loan_snapshot(spark, sf).select(*KEYS, days.alias("days_past_due_derived"))


@query("fea_risk_category", using("risk") + f"SELECT {SQL_KEYS}, risk_category FROM risk")
def fea_risk_category(spark, sf):
    category = risk.risk_category(F.col("account_status_l1"), F.col("account_status_l2"), F.col("days_past_due"))
    return a.loan_snapshot(spark, sf).select(*KEYS, category.alias("risk_category"))


@query("fea_nps_segment", using("nps") + "SELECT respondent_id, nps_score, nps_segment FROM nps")
def fea_nps_segment(spark, sf):
    return a.scored_survey(spark, sf).select("respondent_id", "nps_score", "nps_segment")


@query("dim_customer", using("dim") + f"""
SELECT loan_id, cust_id, {sql_day('dob')} || ' 00:00:00' AS dob, received_total, duration_months, gender, product_name,
  {sql_round('avg_monthly_income', 6)} AS avg_monthly_income, avg_monthly_income_band FROM dim""")
def dim_customer(spark, sf):
    return rounded(a.customer_dimension(spark, sf), 6, "avg_monthly_income")


@query("fct_credit_snapshot", using("fct") + f"""
SELECT * REPLACE ({sql_day('snapshot_date')} AS snapshot_date, {sql_day('reporting_date')} AS reporting_date,
  {sql_day('next_invoice_date')} AS next_invoice_date, {sql_day('dob')} || ' 00:00:00' AS dob) FROM fct""")
def fct_credit_snapshot(spark, sf):
    return a.credit_fact(spark, sf)


@query("join_fact_dob", using("ls", "lc") + f"""
SELECT ls.loan_id, line_no, {sql_day('snapshot_date')} AS snapshot_date, {sql_day('dob')} || ' 00:00:00' AS dob
FROM ls LEFT JOIN lc ON ls.loan_id = lc.loan_id""")
def join_fact_dob(spark, sf):
    return marts.with_dob(a.loan_snapshot(spark, sf), a.loan_customer(spark, sf)).select(*KEYS, "dob")
