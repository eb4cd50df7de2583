"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.operators import quality
from loanlens.plans.staging import clean_credit_snapshot
from loanlens.registry import adapters as a
from loanlens.registry.adapters import AS_OF, sql_day, sql_round, using
from loanlens.registry.core import query, table
from loanlens.registry.q_sources import write_snapshot_files
from loanlens.schemas import NULL_TOLERANCES
from loanlens.session import materialised, shared_dir
from loanlens.sources import snapshots
from loanlens.sources.tables import append_log

LOST = ["DEPOSIT", "WEEKLY_RATE"]


@query("dq_schema_contract", using("ls") + f"""
SELECT {sql_day('s.snapshot_date')} AS snapshot_date, m.missing_column
FROM (SELECT max(snapshot_date) AS snapshot_date FROM ls) AS s,
  (VALUES {', '.join(f"('{name}')" for name in LOST)}) AS m(missing_column)""")
def dq_schema_contract(spark, sf):
    """Raw files of all snapshots; some have their headers in lower case, the newest lacks columns."""
    root = shared_dir(spark, "contract")
    raw = a.raw_credit(spark, sf)
    year, newest = F.year("snapshot_date"), F.year(raw.agg(F.max("snapshot_date")).scalar())
    write_snapshot_files(raw.filter(year % 2 == 0).filter(year < newest), root)
    lower = raw.filter(year % 2 == 1).filter(year < newest)
    write_snapshot_files(lower.toDF(*[c.lower() for c in lower.columns]), root)
    write_snapshot_files(raw.filter(year == newest).drop(*LOST), root)
    exports = snapshots.find_snapshots(spark, f"{root}/*{snapshots.FILE_GLOB}")
    return quality.schema_contract(quality.raw_manifest(spark, snapshots.manifest(exports)))


AGREEMENT = f"""SELECT {sql_day('snapshot_date')} AS snapshot_date, count(DISTINCT reporting_date) AS n_dates,
  {sql_day('min(reporting_date)')} AS first_date, {sql_day('max(reporting_date)')} AS last_date,
  CASE WHEN count(reporting_date) = 0 THEN 'no date' WHEN count(DISTINCT reporting_date) > 1 THEN 'several dates'
    WHEN min(reporting_date) <> snapshot_date THEN 'other date' ELSE 'agrees' END AS verdict
FROM ls GROUP BY snapshot_date"""


@query("dq_date_mismatch", using("ls") + f"SELECT * FROM ({AGREEMENT}) AS found WHERE verdict <> 'agrees'")
def dq_date_mismatch(spark, sf):
    return quality.date_mismatches(a.loan_snapshot(spark, sf))


@query("dq_uniqueness", f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, CAST(sum(n) AS BIGINT) AS n_dupes FROM (
  SELECT date_trunc('year', l_shipdate) AS snapshot_date, l_orderkey, l_linenumber, count(*) AS n
  FROM lineitem GROUP BY ALL HAVING count(*) > 1) AS repeated GROUP BY snapshot_date""")
def dq_uniqueness(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("snapshot_date", F.trunc("l_shipdate", "year"))
    return quality.uniqueness(lines, "l_orderkey", "l_linenumber")


def _orphan_sql(source: str, rows: str, target: str, known: str) -> str:
    return f"""SELECT DISTINCT '{source}' AS source, '{target}' AS missing_in, CAST(loan_id AS VARCHAR) AS loan_id FROM {rows}
WHERE loan_id NOT IN (SELECT loan_id FROM {known})"""


@query("dq_referential", using("ls", "lc", "nps") + " UNION ALL ".join((
    _orphan_sql("credit", "ls", "customer", "lc"), _orphan_sql("nps", "nps", "customer", "lc"), _orphan_sql("nps", "nps", "credit", "ls"))))
def dq_referential(spark, sf):
    return quality.orphans(
        credit=a.loan_snapshot(spark, sf), customer=a.loan_customer(spark, sf), nps=a.scored_survey(spark, sf)
    )


AGE = f"((DATE '{AS_OF}' - dob) / 365.25)"


@query("dq_ranges", using("lc", "nps", "ls") + f"""
SELECT 'age_bounds' AS "check", count(*) AS n_failed FROM lc WHERE {AGE} < 18 OR {AGE} > 100
UNION ALL SELECT 'income_positive', count(*) FROM lc WHERE received_total <= 0
UNION ALL SELECT 'nps_score_range', count(*) FROM nps WHERE nps_score < 0 OR nps_score > 10
UNION ALL SELECT 'dpd_non_negative', count(*) FROM ls WHERE days_past_due < 0""")
def dq_ranges(spark, sf):
    return quality.range_counts(
        a.loan_customer(spark, sf), a.scored_survey(spark, sf), a.loan_snapshot(spark, sf), a.as_of()
    )


def _null_sql(column: str, limit: float, known: bool) -> str:
    issue, share = ("null_share", f"CAST(count(*) - count({column}) AS DOUBLE) / count(*)") if known else ("missing_column", "CAST(1 AS DOUBLE)")
    return f"""SELECT {sql_day('snapshot_date')} AS snapshot_date, '{column}' AS "column", '{issue}' AS issue,
  {sql_round(f'100 * ({share})', 2)} AS pct_null, CAST({100 * limit} AS DOUBLE) AS pct_tolerated
FROM clean GROUP BY snapshot_date {f'HAVING {share} > {limit}' if known else ''}"""


@query("dq_null_thresholds", using("clean") + " UNION ALL ".join(
    _null_sql(c, limit, c != "sale_date") for c, limit in NULL_TOLERANCES.items()))
def dq_null_thresholds(spark, sf):
    return quality.null_breaches(clean_credit_snapshot(a.raw_credit(spark, sf)).drop("sale_date"))


GAP = "abs(days_past_due_derived - days_past_due)"
EXACT = f"100.0 * count(CASE WHEN {GAP} = 0 THEN 1 END) / count({GAP})"
WITHIN = f"100.0 * count(CASE WHEN {GAP} <= 7 THEN 1 END) / count({GAP})"


@query("dq_dpd_reconciliation", using("risk") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS rows, {sql_round(EXACT, 2)} AS exact_match_pct,
  {sql_round(WITHIN, 2)} AS within_7d_pct, {sql_round(WITHIN, 2)} < 50 AS breached FROM risk GROUP BY snapshot_date""")
def dq_dpd_reconciliation(spark, sf):
    return quality.dpd_reconciliation(a.classified(spark, sf))


def _suite(spark, sf):
    # The suite reads the fact three times; written, it is derived once.
    fct = materialised(a.credit_fact(spark, sf), "suite-fact")
    return quality.run_suite(
        fct, a.loan_customer(spark, sf), a.scored_survey(spark, sf), a.as_of(), unique_on=("loan_id", "line_no")
    )


# The fact lacks most of the contract's columns, so every snapshot fails on columns and,
# holding many reporting dates, on dates too; sale_date is absent, so each breaches once.
SUITE = using("risk", "lc", "nps") + f""", per AS (
  SELECT snapshot_date, count(*) AS n, min(reporting_date) AS lo, max(reporting_date) AS hi,
    count(CASE WHEN days_past_due < 0 THEN 1 END) AS negative, {sql_round(EXACT, 2)} AS exact, {sql_round(WITHIN, 2)} AS within,
    1 + CASE WHEN count(loan_id) < count(*) THEN 1 ELSE 0 END + CASE WHEN count(reporting_date) < count(*) THEN 1 ELSE 0 END
      + CASE WHEN (count(*) - count(balance)) / count(*) > 0.01 THEN 1 ELSE 0 END
      + CASE WHEN (count(*) - count(account_status_l2)) / count(*) > 0.01 THEN 1 ELSE 0 END
      + CASE WHEN (count(*) - count(next_invoice_date)) / count(*) > 0.20 THEN 1 ELSE 0 END AS breaches
  FROM risk GROUP BY snapshot_date),
tot AS (
  SELECT count(*) AS snapshots, count(CASE WHEN lo <> snapshot_date OR hi <> snapshot_date THEN 1 END) AS mismatches,
    sum(negative) AS negative, sum(breaches) AS breaches, count(CASE WHEN within < 50 THEN 1 END) AS dpd,
    '[' || string_agg(printf('{{"snapshot_date":"%s","rows":%d,"exact_match_pct":%s,"within_7d_pct":%s}}',
      {sql_day('snapshot_date')}, n, CAST(exact AS VARCHAR), CAST(within AS VARCHAR)), ',' ORDER BY snapshot_date) || ']' AS lines
  FROM per),
dup AS (SELECT coalesce(sum(n), 0) AS n FROM (
  SELECT count(*) AS n FROM risk GROUP BY loan_id, line_no, snapshot_date HAVING count(*) > 1) AS repeated),
orphan AS (SELECT
  (SELECT count(DISTINCT loan_id) FROM risk WHERE loan_id NOT IN (SELECT loan_id FROM lc)) AS credit,
  (SELECT count(DISTINCT loan_id) FROM nps WHERE loan_id NOT IN (SELECT loan_id FROM lc)) AS nps_customer,
  (SELECT count(DISTINCT loan_id) FROM nps WHERE loan_id NOT IN (SELECT loan_id FROM risk)) AS nps_credit),
rng AS (SELECT
  (SELECT count(*) FROM lc WHERE {AGE} < 18 OR {AGE} > 100) AS age,
  (SELECT count(*) FROM lc WHERE received_total <= 0) AS income,
  (SELECT count(*) FROM nps WHERE nps_score < 0 OR nps_score > 10) AS score),
results AS (
  SELECT 'schema_and_freshness' AS name, 'critical' AS severity, 'real_time' AS cadence, snapshots + mismatches AS n_failed,
    printf('{{"snapshots":%d,"date_mismatches":%d}}', snapshots, mismatches) AS detail FROM tot
  UNION ALL SELECT 'uniqueness_loan_snapshot', 'critical', 'daily', n, printf('{{"duplicate_rows":%d}}', CAST(n AS BIGINT)) FROM dup
  UNION ALL SELECT 'referential_integrity', 'warning', 'daily', credit + nps_customer,
    printf('{{"credit_not_in_customer":%d,"nps_not_in_customer":%d,"nps_not_in_credit":%d}}', credit, nps_customer, nps_credit) FROM orphan
  UNION ALL SELECT 'range_checks', 'warning', 'daily', age + income + score + negative,
    printf('{{"age_bounds":%d,"income_positive":%d,"nps_score_range":%d,"dpd_non_negative":%d}}', age, income, score, CAST(negative AS BIGINT))
    FROM rng, tot
  UNION ALL SELECT 'null_thresholds', 'warning', 'daily', breaches,
    printf('{{"null_breaches":%d,"snapshots":%d}}', CAST(breaches AS BIGINT), snapshots) FROM tot
  UNION ALL SELECT 'dpd_reconciliation', 'info', 'weekly', dpd, lines FROM tot)
"""


@query("dq_suite", SUITE + """
SELECT name, severity, cadence, n_failed = 0 AS passed, CAST(n_failed AS BIGINT) AS n_failed, detail FROM results""")
def dq_suite(spark, sf):
    return _suite(spark, sf)


@query("dq_routes", SUITE + """
SELECT name, n_failed = 0 AS passed, CASE WHEN n_failed > 0 THEN CASE severity WHEN 'critical' THEN 'page'
  WHEN 'warning' THEN 'chat' ELSE 'digest' END END AS route FROM results""")
def dq_routes(spark, sf):
    return quality.with_routes(_suite(spark, sf)).select("name", "passed", "route")


@query("dq_gate", SUITE + """
SELECT count(*) AS n_critical, count(*) > 0 AS blocked FROM results WHERE severity = 'critical' AND n_failed > 0""")
def dq_gate(spark, sf):
    return quality.gate(_suite(spark, sf))


@query("dq_log_append", SUITE + """
SELECT name, CAST(2 AS BIGINT) AS runs, CAST(2 * n_failed AS BIGINT) AS n_failed FROM results""")
def dq_log_append(spark, sf):
    log = shared_dir(spark, "dq-log")
    results = materialised(_suite(spark, sf), "dq-results")
    for _ in range(2):
        append_log(results.withColumn("ts", F.current_timestamp()), log)
    return spark.read.parquet(log).groupBy("name").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("n_failed").alias("n_failed")
    )
