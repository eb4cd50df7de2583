"""Key relationships and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.operators import keys, profiling
from loanlens.plans import pipeline
from loanlens.registry import adapters as a
from loanlens.registry.adapters import AS_OF, sql_day, sql_round, using
from loanlens.registry.core import query, rounded, table

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]


@query("orphan_keys", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orphan_keys(spark, sf):
    return keys.orphan_keys(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


def _cover_sql(source: str, target: str, left: str, right: str) -> str:
    covered = f"(SELECT count(DISTINCT k) FROM {left} WHERE k IN (SELECT k FROM {right}))"
    whole = f"(SELECT count(DISTINCT k) FROM {left})"
    return f"""SELECT '{source}' AS source, '{target}' AS target, {whole} AS n_keys, {covered} AS n_covered,
  {sql_round(f'100.0 * {covered} / {whole}', 2)} AS coverage_pct"""


def _keys_sql(**sources: tuple[str, str]) -> str:
    return "WITH " + ", ".join(f"k_{name} AS (SELECT {key} AS k FROM {src})" for name, (src, key) in sources.items())


@query("key_coverage", _keys_sql(documents=("documents", "doc_id"), labels=("labels", "doc_id"),
                                 orders=("orders", "o_orderkey"), lineitem=("lineitem", "l_orderkey")) + " " +
       _cover_sql("documents", "labels", "k_documents", "k_labels") + " UNION ALL " +
       _cover_sql("orders", "lineitem", "k_orders", "k_lineitem"))
def key_coverage(spark, sf):
    documents = keys.key_presence(
        documents=(table(spark, sf, "documents"), "doc_id"), labels=(table(spark, sf, "labels"), "doc_id")
    )
    orders = keys.key_presence(
        orders=(table(spark, sf, "orders"), "o_orderkey"), lineitem=(table(spark, sf, "lineitem"), "l_orderkey")
    )
    return keys.coverage(documents, [("documents", "labels")]).unionByName(keys.coverage(orders, [("orders", "lineitem")]))


LOAN_TEXT = "'loan-' || l_orderkey"
RELATED = f"""WITH credit AS (SELECT {LOAN_TEXT} AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sales AS (SELECT CASE WHEN l_quantity <> 50 THEN {LOAN_TEXT} END AS k FROM lineitem),
gender AS (SELECT CASE WHEN l_quantity = 49 THEN '#N/A' ELSE {LOAN_TEXT} END AS k FROM lineitem),
dob AS (SELECT 'loan-' || user_id AS k FROM events),
income AS (SELECT CASE WHEN l_quantity = 48 THEN '#N/A' ELSE {LOAN_TEXT} END AS k FROM lineitem),
nps AS (SELECT CASE WHEN event_type <> 'click' OR value >= 10 THEN 'loan-' || user_id END AS k FROM events)
"""
SOURCES = ["credit", "sales", "gender", "dob", "income", "nps"]
PAIRS = [("credit", "sales"), ("credit", "gender"), ("credit", "dob"), ("credit", "income"), ("nps", "credit")]


def _relation_sql() -> str:
    rows = [f"SELECT '{s}_unique_keys' AS metric, CAST(count(DISTINCT k) AS DOUBLE) AS value FROM {s}" for s in SOURCES]
    rows += [f"SELECT '{s}_unresolved_keys', CAST(count(*) AS DOUBLE) FROM {s} WHERE k = '#N/A'"
             for s in ("gender", "income", "dob")]
    for left, right in PAIRS:
        share = (f"100.0 * (SELECT count(DISTINCT k) FROM {left} WHERE k IN (SELECT k FROM {right} WHERE k IS NOT NULL))"
                 f" / (SELECT count(DISTINCT k) FROM {left})")
        rows.append(f"SELECT '{left}_in_{right}_pct', {sql_round(share, 2)}")
    rows += [f"SELECT '{s}_duplicate_keys', CAST(count(*) - count(DISTINCT k) - max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS DOUBLE) FROM {s}"
             for s in ("sales", "gender", "dob", "income")]
    return " UNION ALL ".join(rows)


@query("relationship_metrics", RELATED + _relation_sql())
def relationship_metrics(spark, sf):
    raw = a.raw_customer_tables(spark, sf)
    loans = a.loan_snapshot(spark, sf).select(F.concat(F.lit("loan-"), F.col("loan_id").cast("string")).alias("loan_id"))
    presence = keys.key_presence(
        credit=(loans, "loan_id"), sales=(raw["sales"], "Loan Id"), gender=(raw["gender"], "Loan Id"),
        dob=(raw["dob"], "Loan Id "), income=(raw["income"], "Loan Id"), nps=(a.raw_survey(spark, sf), "Loan Id"),
    )
    return keys.relationship_metrics(
        presence, unresolved=["gender", "income", "dob"], pairs=PAIRS,
        duplicates=["sales", "gender", "dob", "income"], sources=SOURCES,
    )


def _text(column: str, dtype: str) -> str:
    return f"CAST({column} + CAST(0 AS DOUBLE) AS VARCHAR)" if dtype == "double" else f"CAST({column} AS VARCHAR)"


TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
         "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "l_linenumber": "int", "l_quantity": "double",
         "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_orderkey": "bigint",
         "l_partkey": "bigint", "l_suppkey": "bigint", "l_extendedprice": "double", "l_shipdate": "timestamp_ntz"}


def _profile_sql(source: str, relation: str, column: str, group: str = "") -> str:
    dtype = TYPES[column]
    return f"""SELECT {source} AS source, '{column}' AS "column", '{dtype}' AS dtype, count(*) AS rows,
  count(*) - count({column}) AS n_null, {sql_round(f'100.0 * (count(*) - count({column})) / count(*)', 2)} AS pct_null,
  count(DISTINCT {column}) AS n_unique, min({_text(column, dtype)}) AS sample FROM {relation} {group}"""


@query("profile_columns", " UNION ALL ".join(
    [_profile_sql("'orders'", "orders", c) for c in ORDER_COLUMNS]
    + [_profile_sql("'lineitem'", "lineitem", c) for c in LINE_COLUMNS]))
def profile_columns(spark, sf):
    orders = profiling.column_profile(table(spark, sf, "orders").select(ORDER_COLUMNS), "orders")
    lines = profiling.column_profile(table(spark, sf, "lineitem").select(LINE_COLUMNS), "lineitem")
    return orders.unionByName(lines)


@query("profile_by_snapshot", " UNION ALL ".join(
    _profile_sql("'credit::' || year(l_shipdate) || '-01-01'", "lineitem", c, "GROUP BY year(l_shipdate)") for c in LINE_COLUMNS))
def profile_by_snapshot(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.trunc("l_shipdate", "year").alias("snapshot_date"), *LINE_COLUMNS)
    return profiling.column_profile(lines, "credit", by="snapshot_date")


# Derived type of each raw column, and when its value is missing; every snapshot has all kinds of rows.
RAW_KINDS = {
    "string": ["LOAN_ID", "DATE", "BALANCE_DUE_STATUS", "ACCOUNT_STATUS_L1", "ACCOUNT_STATUS_L2", "CREDIT_CHECK_DONE"],
    "whole": ["CUSTOMER_AGE", "ADVANCE", "EXPECTED_PAYMENT", "FIRST_PAYMENT", "FIRST_EXPECTED_PAYMENT", "PREPAYMENT_AMOUNT",
              "INITIAL_PAY", "TOTAL_PAID_WITH_ADJUSTMENTS_15D"],
    "fraction": ["TOTAL_PAID", "TOTAL_DUE_TODAY", "BALANCE", "DAYS_PAST_DUE", "CLOSING_BALANCE", "BALANCE_DUE_TO_DATE", "ARREARS",
                 "PAYMENT", "PAYMENT_AMOUNT", "DEPOSIT", "WEEKLY_RATE", "DISCOUNT", "OVERPAYMENT_AMOUNT"],
    "date": ["RETURN_DATE", "SALE_DATE", "CREDIT_EXPIRY", "NEXT_INVOICE_DATE", "MAX_PAYMENT_DATE"],
    "empty": ["ADJUSTMENT_AMOUNT"],
}
RAW_NULLS = {"LOAN_ID": "l_quantity IN (49, 50)", "TOTAL_DUE_TODAY": "l_quantity = 44", "RETURN_DATE": "l_returnflag <> 'R'",
             "PAYMENT_AMOUNT": "l_returnflag = 'A'", "ADJUSTMENT_AMOUNT": "true"}


def _raw_sql(column: str, kind: str) -> str:
    missing = f"count(CASE WHEN {RAW_NULLS.get(column, 'false')} THEN 1 END)"
    text = a.RAW_TEXT.get(column) or a.RAW_WHOLE.get(column) or f"CAST({a.RAW_NUMBER[column]} AS DOUBLE)"
    value = f"CASE WHEN NOT ({RAW_NULLS.get(column, 'false')}) THEN CAST({text} AS VARCHAR) END"
    odd = "count(CASE WHEN l_quantity = 46 THEN 1 END)"
    filled = f"count(*) - {missing}"
    n = {"string": "n_text", "whole": "n_whole", "fraction": "n_fraction", "date": "n_date", "empty": None}[kind]
    kinds = {k: filled if k == n else "CAST(0 AS BIGINT)" for k in ("n_whole", "n_fraction", "n_date", "n_text")}
    if column == "DATE":
        kinds |= {"n_date": f"{filled} - {odd}", "n_text": odd}
    return f"""SELECT 'credit::' || {sql_day('snapshot_date')} AS source, '{column}' AS "column", '{kind}' AS dtype, count(*) AS rows,
  {missing} AS n_null, {sql_round(f'100.0 * {missing} / count(*)', 2)} AS pct_null, count(DISTINCT {value}) AS n_unique,
  min({value}) AS sample, {", ".join(f"{sql} AS {k}" for k, sql in kinds.items())} FROM raw GROUP BY snapshot_date"""


@query("profile_raw_credit", using("raw") + " UNION ALL ".join(_raw_sql(c, kind) for kind, names in RAW_KINDS.items() for c in names))
def profile_raw_credit(spark, sf):
    return profiling.raw_profile(a.raw_credit(spark, sf), "credit", by="snapshot_date")


@query("vocabulary", using("raw") + " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", {a.RAW_TEXT[c]} AS value, count(*) AS n FROM raw GROUP BY 2' for c in pipeline.VOCABULARIES))
def vocabulary(spark, sf):
    return profiling.vocabulary(a.raw_credit(spark, sf), pipeline.VOCABULARIES)


@query("value_counts", using("raw") + """
SELECT CASE l_returnflag WHEN 'R' THEN 'Arrears' WHEN 'A' THEN ' up to date' ELSE 'Advance ' END AS value, count(*) AS n
FROM raw GROUP BY 1""")
def value_counts(spark, sf):
    return profiling.value_counts(a.raw_credit(spark, sf), "BALANCE_DUE_STATUS")


def _summary_sql(relation: str, column: str) -> str:
    cuts = ", ".join(f"{sql_round(f'quantile_cont({column}, {p})', 4)} AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{column}' AS "column", count({column}) AS count, {sql_round(f'avg({column})', 4)} AS mean,
  {sql_round(f'stddev_samp({column})', 4)} AS std, min({column}) AS min, {cuts}, max({column}) AS max FROM {relation}"""


@query("numeric_summary", using("ls") + " UNION ALL ".join(
    _summary_sql("ls", c) for c in ("balance", "total_paid", "days_past_due")))
def numeric_summary(spark, sf):
    summary = profiling.numeric_summary(a.loan_snapshot(spark, sf), ["balance", "total_paid", "days_past_due"])
    return rounded(summary, 4, "mean", "std", "p25", "p50", "p75")


@query("year_histogram", """
WITH years AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1)
SELECT year, n, CAST(row_number() OVER (ORDER BY year NULLS LAST) AS INTEGER) AS from_first,
  CAST(row_number() OVER (ORDER BY year DESC NULLS FIRST) AS INTEGER) AS from_last,
  min(year) OVER () AS first_year, max(year) OVER () AS last_year FROM years""")
def year_histogram(spark, sf):
    return profiling.year_histogram(table(spark, sf, "orders"), "o_orderdate")


AGE = f"((DATE '{AS_OF}' - dob) / 365.25)"


@query("outlier_counts", using("lc", "sv") + f"""
SELECT 'age_below_18' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lc WHERE {AGE} < 18
UNION ALL SELECT 'age_100_or_more', count(*) FROM lc WHERE {AGE} >= 100
UNION ALL SELECT 'age_min', {sql_round(f'min({AGE})', 1)} FROM lc
UNION ALL SELECT 'age_max', {sql_round(f'max({AGE})', 1)} FROM lc
UNION ALL SELECT 'income_not_positive', count(*) FROM lc WHERE received_total <= 0
UNION ALL SELECT 'distinct_durations', count(DISTINCT duration_months) FROM lc
UNION ALL SELECT 'score_out_of_range', count(*) FROM sv WHERE nps_score < 0 OR nps_score > 10""")
def outlier_counts(spark, sf):
    customers = a.loan_customer(spark, sf)
    return profiling.outlier_counts(customers, customers, a.survey(spark, sf), a.as_of())


@query("dataset_summary", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS rows, CAST({n} AS BIGINT) AS cols"
    for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11), ("events", 6))))
def dataset_summary(spark, sf):
    return profiling.dataset_summary(**{t: table(spark, sf, t) for t in ("customer", "orders", "lineitem", "events")})


