"""Portfolio, segment and survey metrics."""

from __future__ import annotations


from pyspark.sql import functions as F

from loanlens.operators import metrics, state
from loanlens.registry import adapters as a
from loanlens.registry.adapters import sql_day, sql_round, using
from loanlens.registry.core import query, rounded
from loanlens.functions.risk import RETURNED
from loanlens.session import materialised, shared_dir

RATES = ("delinquency_rate", "par90_rate", "write_off_rate")


def _rate(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


DELINQUENT = sql_round(_rate("days_past_due > 0"), 6)
PAR90 = sql_round(_rate("days_past_due >= 90"), 6)
WRITTEN_OFF = sql_round(_rate("account_status_l1 IN ('Write Off', 'Lost Write Off')"), 6)
COLLECTED = sql_round(
    "sum(CASE WHEN account_status_l2 <> 'Paid Off' THEN total_paid END)"
    " / nullif(sum(CASE WHEN account_status_l2 <> 'Paid Off' THEN total_due_today END), 0)", 6)


PORTFOLIO_SQL = using("risk") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS active_loans,
  {sql_round('sum(balance)', 4)} AS total_outstanding, {sql_round('sum(arrears)', 4)} AS total_arrears,
  {sql_round('sum(total_paid)', 4)} AS total_paid_cum, {sql_round('sum(total_due_today)', 4)} AS total_due_cum,
  {DELINQUENT} AS delinquency_rate, {PAR90} AS par90_rate, {WRITTEN_OFF} AS write_off_rate,
  {sql_round(_rate("account_status_l2 = 'Paid Off'"), 6)} AS paid_off_rate, {COLLECTED} AS collection_rate_active
FROM risk WHERE risk_category <> 'Returned' GROUP BY snapshot_date ORDER BY snapshot_date"""


def _rounded_kpis(kpis):
    kpis = rounded(kpis, 4, "total_outstanding", "total_arrears", "total_paid_cum", "total_due_cum")
    return rounded(kpis, 6, *RATES, "paid_off_rate", "collection_rate_active")


@query("portfolio_kpis", PORTFOLIO_SQL)
def portfolio_kpis(spark, sf):
    return _rounded_kpis(metrics.portfolio_kpis(a.classified(spark, sf)))


def stored_states(fct, *dims):
    """States as they grow: older snapshots first, then the newest in part, then all of it again."""
    path = shared_dir(fct.sparkSession, "states")
    fct = materialised(fct, "fact")
    newest = F.col("snapshot_date") == fct.agg(F.max("snapshot_date")).scalar()
    for part in (~newest, newest & (F.col("days_past_due") > 0), newest):
        state.keep(state.portfolio_state(fct.filter(part), *dims), path)
    return fct.sparkSession.read.parquet(path)


@query("portfolio_kpis_incremental", PORTFOLIO_SQL)
def portfolio_kpis_incremental(spark, sf):
    return _rounded_kpis(state.portfolio_kpis(stored_states(a.classified(spark, sf), "risk_category")))


@query("collection_rate", using("risk") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, {COLLECTED} AS collection_rate_active
FROM risk WHERE risk_category <> 'Returned' GROUP BY snapshot_date""")
def collection_rate(spark, sf):
    return rounded(metrics.collection_rates(a.classified(spark, sf)), 6, "collection_rate_active")


def _segment_sql(dim: str) -> str:
    return f"""SELECT snapshot_date, '{dim}' AS segment_dim, {dim} AS segment, count(*) AS n_loans,
  {DELINQUENT} AS delinquency_rate, {PAR90} AS par90_rate, {WRITTEN_OFF} AS write_off_rate
FROM base GROUP BY snapshot_date, {dim}"""


BASE = using("fct", "dim") + """, base AS (
  SELECT fct.*, dim.avg_monthly_income_band AS income_band
  FROM fct LEFT JOIN dim ON fct.loan_id = dim.loan_id WHERE risk_category <> 'Returned')
"""


def _day_replaced(inner: str) -> str:
    return f"SELECT * REPLACE ({sql_day('snapshot_date')} AS snapshot_date) FROM ({inner}) AS result"


def _segment_rows(spark, sf):
    return metrics.segment_base(
        a.credit_fact(spark, sf), a.customer_dimension(spark, sf), income_band="avg_monthly_income_band"
    )


@query("segment_kpis_age", BASE + _day_replaced(_segment_sql("age_band")))
def segment_kpis_age(spark, sf):
    return rounded(metrics.segment_kpis(metrics.book(a.credit_fact(spark, sf)), "age_band"), 6, *RATES)


@query("segment_kpis_income", BASE + _day_replaced(_segment_sql("income_band")))
def segment_kpis_income(spark, sf):
    fct = a.classified(spark, sf)
    rows = metrics.segment_base(fct, a.customer_dimension(spark, sf), income_band="avg_monthly_income_band")
    return rounded(metrics.segment_kpis(rows, "income_band"), 6, *RATES)


SEGMENT_SQL = BASE + _day_replaced(f"{_segment_sql('age_band')} UNION ALL {_segment_sql('income_band')}")


@query("segment_kpis", SEGMENT_SQL)
def segment_kpis(spark, sf):
    return rounded(metrics.segment_kpis(_segment_rows(spark, sf), "age_band", "income_band"), 6, *RATES)


@query("segment_kpis_incremental", SEGMENT_SQL)
def segment_kpis_incremental(spark, sf):
    dims = ("age_band", "income_band")
    return rounded(state.segment_kpis(stored_states(_segment_rows(spark, sf), *dims), dims), 6, *RATES)


@query("join_segment_base", BASE + f"""
SELECT loan_id, line_no, {sql_day('snapshot_date')} AS snapshot_date, days_past_due, account_status_l1, account_status_l2,
  risk_category, age_band, income_band FROM base""")
def join_segment_base(spark, sf):
    return _segment_rows(spark, sf).select(
        "loan_id", "line_no", "snapshot_date", "days_past_due", "account_status_l1", "account_status_l2",
        "risk_category", "age_band", "income_band",
    )


@query("divergent_segments", BASE + f""", newest AS (
  SELECT * FROM base WHERE snapshot_date = (SELECT max(snapshot_date) FROM base)),
cells AS (
  SELECT snapshot_date, 'age_band' AS segment_dim, age_band AS segment, count(*) AS n_loans,
    {_rate('days_past_due > 0')} AS rate FROM newest GROUP BY snapshot_date, age_band
  UNION ALL
  SELECT snapshot_date, 'income_band', income_band, count(*), {_rate('days_past_due > 0')}
  FROM newest GROUP BY snapshot_date, income_band),
deltas AS (
  SELECT *, rate - (SELECT {_rate('days_past_due > 0')} FROM newest) AS delta FROM cells WHERE n_loans >= 200)
SELECT {sql_day('snapshot_date')} AS snapshot_date, segment_dim, segment, n_loans,
  {sql_round('rate', 6)} AS delinquency_rate, {sql_round('delta', 6)} AS delta_vs_portfolio
FROM deltas ORDER BY abs(delta) DESC, segment_dim, segment NULLS LAST LIMIT 5""")
def divergent_segments(spark, sf):
    found = metrics.divergent_segments(_segment_rows(spark, sf), "age_band", "income_band")
    return rounded(found, 6, "delinquency_rate", "delta_vs_portfolio")


@query("latest_top_exposures", using("fct", "dim") + f"""
SELECT fct.loan_id, line_no, {sql_day('snapshot_date')} AS snapshot_date, balance, arrears, days_past_due,
  account_status_l2, risk_category, age_band, gender, avg_monthly_income_band, product_name
FROM fct LEFT JOIN dim ON fct.loan_id = dim.loan_id
WHERE snapshot_date = (SELECT max(snapshot_date) FROM fct)
ORDER BY balance DESC, fct.loan_id, line_no, arrears, days_past_due LIMIT 200""")
def latest_top_exposures(spark, sf):
    keep = ["loan_id", "line_no", "arrears", "days_past_due", "snapshot_date", "balance", "account_status_l2",
            "risk_category", "age_band"]
    return metrics.latest_top_exposures(
        a.credit_fact(spark, sf), a.customer_dimension(spark, sf),
        ["gender", "avg_monthly_income_band", "product_name"], keep=keep,
    )


LATEST = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY snapshot_date DESC, risk_category,
      days_past_due, account_status_l2, balance, arrears, line_no) AS place FROM risk) AS ranked WHERE place = 1)
"""
STATE = ("risk_category", "days_past_due", "account_status_l2", "balance", "arrears", "line_no")


@query("latest_state", using("risk") + "," + LATEST + f"""
SELECT loan_id, {sql_day('snapshot_date')} AS snapshot_date, risk_category, days_past_due, account_status_l2,
  balance, arrears, line_no FROM latest""")
def latest_state(spark, sf):
    return metrics.latest_state(a.classified(spark, sf).select("loan_id", "snapshot_date", *STATE))


SURVEYED = using("risk", "nps") + "," + LATEST + """, surveyed AS (
  SELECT nps.*, latest.risk_category, latest.days_past_due, latest.account_status_l2
  FROM nps JOIN latest ON nps.loan_id = latest.loan_id)
"""


def _surveyed(spark, sf):
    return metrics.survey_with_credit(a.scored_survey(spark, sf), a.classified(spark, sf), keep=STATE)


@query("join_survey_latest", SURVEYED + """
SELECT respondent_id, loan_id, nps_score, nps_segment, risk_category, days_past_due, account_status_l2 FROM surveyed""")
def join_survey_latest(spark, sf):
    return _surveyed(spark, sf).select(
        "respondent_id", "loan_id", "nps_score", "nps_segment", "risk_category", "days_past_due", "account_status_l2"
    )


PROMOTERS, DETRACTORS = _rate("nps_segment = 'Promoter'"), _rate("nps_segment = 'Detractor'")
NET = sql_round(f"100 * ({PROMOTERS} - {DETRACTORS})", 6)


@query("nps_by_risk", SURVEYED + f"""
SELECT risk_category, count(*) AS n_responses, {sql_round('avg(nps_score)', 6)} AS mean_nps,
  {sql_round(PROMOTERS, 6)} AS promoter_rate, {sql_round(DETRACTORS, 6)} AS detractor_rate, {NET} AS net_promoter_score,
  {sql_round(_rate("phone_locked_despite_payment = 'Yes'"), 6)} AS pct_locked_after_paying,
  {sql_round(_rate("experienced_payment_delay = 'Yes'"), 6)} AS pct_payment_delay
FROM surveyed GROUP BY risk_category""")
def nps_by_risk(spark, sf):
    return rounded(
        metrics.nps_by_risk(_surveyed(spark, sf)), 6, "mean_nps", "promoter_rate", "detractor_rate",
        "net_promoter_score", "pct_locked_after_paying", "pct_payment_delay",
    )


@query("net_promoter", using("nps") + f"""
SELECT event_type, count(*) AS n_responses, {NET} AS net_promoter_score FROM nps GROUP BY event_type""")
def net_promoter(spark, sf):
    return rounded(metrics.net_promoter(a.scored_survey(spark, sf), "event_type"), 6, "net_promoter_score")


def _filled_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS n_filled, count(*) AS rows,
  {sql_round(f'100.0 * count({column}) / count(*)', 1)} AS filled_pct FROM lc"""


@query("coverage_report", using("lc") + " UNION ALL ".join(map(_filled_sql, ("gender", "dob", "received_total"))))
def coverage_report(spark, sf):
    return metrics.coverage_report(a.loan_customer(spark, sf), ["gender", "dob", "received_total"])


@query("snapshot_counts", using("ls") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS rows, count(DISTINCT loan_id) AS unique_loans
FROM ls GROUP BY snapshot_date""")
def snapshot_counts(spark, sf):
    return metrics.snapshot_counts(a.loan_snapshot(spark, sf))


def _growth_sql(measure: str) -> str:
    return f"""SELECT '{measure}' AS measure, {sql_round(f'min_by({measure}, snapshot_date)', 4)} AS first,
  {sql_round(f'max_by({measure}, snapshot_date)', 4)} AS latest,
  {sql_round(f'CAST(max_by({measure}, snapshot_date) AS DOUBLE) / min_by({measure}, snapshot_date)', 6)} AS ratio FROM kpis"""


@query("portfolio_growth", using("risk") + f""", kpis AS (
  SELECT snapshot_date, count(*) AS active_loans, sum(balance) AS total_outstanding
  FROM risk WHERE risk_category <> '{RETURNED}' GROUP BY snapshot_date)
{_growth_sql('active_loans')} UNION ALL {_growth_sql('total_outstanding')}""")
def portfolio_growth(spark, sf):
    growth = metrics.portfolio_growth(metrics.portfolio_kpis(a.classified(spark, sf)))
    return rounded(rounded(growth, 4, "first", "latest"), 6, "ratio")


