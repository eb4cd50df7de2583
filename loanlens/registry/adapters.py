"""The given tables seen as a loan book: one frame per adapter, and the same in SQL.

A line item plays a loan in a yearly snapshot, an order the loan's customer record, an
event a survey response.  Loans of orders still pending (status P) have no customer
record yet.  The given tables hold no nulls, so missing values come from the rules here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.bands import nps_segment
from loanlens.plans import marts
from loanlens.registry.core import table

SCORE_HEADER = "On a scale from 0 to 10, how likely are you to recommend us?"
DELAY_HEADER = "Have you ever experienced a delay in your payment reflecting in your account?"
LOCK_HEADER = "Have you ever had your phone lock despite making a payment on time?"
REASON_HEADER = "What is the reason for your score?"

AS_OF = "1998-12-30"


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _lines_with_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables grow, and the size of a file tells little of the hash table that each task would
    hold: millions of keys fit the few MB below which Spark broadcasts.  Sorted sides can spill."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)


def _status_l1() -> Column:
    returned = F.col("l_returnflag") == "R"
    return (
        F.when(returned & (F.col("l_tax") >= 0.07), "Write Off")
        .when(returned, "Cancelled Returned in 3 mths")
        .otherwise("Existing Active")
    )


def _status_l2() -> Column:
    level = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(level == "1", "PAR 30").when(level == "2", "PAR 7").when(level == "3", "Paid Off")
        .when(level == "4", "Unknown").otherwise("Active")
    )


def _overdue_days() -> Column:
    return F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint") * 2).otherwise(F.lit(0))


def loan_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.abs("l_discount"), F.abs("l_tax")
    return _lines_with_orders(spark, sf).select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.trunc("l_shipdate", "year").alias("snapshot_date"),
        F.col("l_shipdate").cast("date").alias("reporting_date"),
        F.col("o_orderdate").cast("date").alias("next_invoice_date"),
        price.alias("balance"),
        (price * discount).alias("arrears"),
        (price * (1 - discount)).alias("total_paid"),
        (price * (1 + tax)).alias("total_due_today"),
        _overdue_days().alias("days_past_due"),
        _status_l1().alias("account_status_l1"),
        _status_l2().alias("account_status_l2"),
    )


def loan_customer(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    born = F.date_add(F.lit("1890-01-01").cast("date"), ((F.col("c_custkey") * 31) % 42000).cast("int"))
    nation = F.col("c_nationkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("c_custkey").alias("cust_id"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", born).cast("timestamp").alias("dob"),
        (F.col("c_acctbal") * 100).alias("received_total"),
        nation.cast("double").alias("duration_months"),
        F.when(nation < 10, "Female").when(nation < 20, "Male").alias("gender"),
        F.col("c_mktsegment").alias("product_name"),
    )


def survey(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    score = F.when(kind != "signup", F.least(F.lit(12.0), F.floor(F.col("value") / 5).cast("double")))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("respondent_id"),
        F.col("user_id").alias("loan_id"),
        score.alias("nps_score"),
        F.when(kind == "error", "Yes").otherwise("No").alias("phone_locked_despite_payment"),
        F.when(kind == "view", "Yes").otherwise("No").alias("experienced_payment_delay"),
        kind.alias("event_type"),
    )


def scored_survey(spark: SparkSession, sf: str) -> DataFrame:
    answered = survey(spark, sf).dropna(subset=["loan_id", "nps_score"])
    return answered.withColumn("nps_segment", nps_segment(F.col("nps_score")))


def customer_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customer(loan_customer(spark, sf))


def credit_fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_credit_snapshot(loan_snapshot(spark, sf), loan_customer(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots with the risk class only, for metrics that do not need the customer."""
    return marts.with_features(loan_snapshot(spark, sf).withColumn("dob", F.lit(None).cast("timestamp")))


def raw_credit(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot rows as a file would hold them: text, with every defect the rules treat."""
    price, discount, tax = F.col("l_extendedprice"), F.abs("l_discount"), F.abs("l_tax")
    quantity = F.col("l_quantity")

    def us(day: str, digits: int = 1) -> Column:
        month, place = (F.lpad(part(day).cast("string"), digits, "0") if digits > 1 else part(day).cast("string") for part in (F.month, F.day))
        return F.concat_ws("/", month, place, F.lpad(F.year(day).cast("string"), 4, "0"))

    loan = F.concat(F.lit("loan-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    flag = F.col("l_returnflag")
    text = {
        "LOAN_ID": F.when(quantity == 50, None).when(quantity == 49, "#N/A")
        .when(quantity == 48, F.concat(F.lit("\t "), loan, F.lit("  "))).otherwise(loan),
        "DATE": F.when(quantity == 47, "13/45/2020").when(quantity == 46, "00:00.0").otherwise(us("l_shipdate")),
        "CUSTOMER_AGE": F.col("l_suppkey"),
        "TOTAL_PAID": price * (1 - discount),
        "TOTAL_DUE_TODAY": F.when(quantity == 44, "N/A").otherwise((price * (1 + tax)).cast("string")),
        "BALANCE": price,
        "DAYS_PAST_DUE": _overdue_days().cast("double"),
        "CLOSING_BALANCE": price,
        "ADVANCE": F.lit("0"),
        "BALANCE_DUE_TO_DATE": price - F.col("o_totalprice"),
        "ARREARS": price * discount,
        "BALANCE_DUE_STATUS": F.when(flag == "R", "Arrears").when(flag == "A", " up to date").otherwise("Advance "),
        "PAYMENT": quantity,
        "EXPECTED_PAYMENT": F.col("l_partkey"),
        "FIRST_PAYMENT": F.lit("0"),
        "FIRST_EXPECTED_PAYMENT": F.lit("0"),
        "ACCOUNT_STATUS_L1": F.when(quantity == 45, "Demo").when(quantity == 43, " demo ").otherwise(_status_l1()),
        "ACCOUNT_STATUS_L2": _status_l2(),
        "RETURN_DATE": F.when(flag == "R", us("l_shipdate")),
        "SALE_DATE": us("o_orderdate"),
        "CREDIT_CHECK_DONE": F.col("o_orderstatus"),
        "PAYMENT_AMOUNT": F.when(flag == "A", "null").otherwise(quantity.cast("string")),
        "ADJUSTMENT_AMOUNT": F.lit("NaN"),
        "PREPAYMENT_AMOUNT": F.lit("0"),
        "DEPOSIT": tax * 100,
        "WEEKLY_RATE": tax,
        "CREDIT_EXPIRY": us("o_orderdate"),
        "NEXT_INVOICE_DATE": us("o_orderdate"),
        "DISCOUNT": discount,
        "OVERPAYMENT_AMOUNT": F.lit("0.0"),
        "MAX_PAYMENT_DATE": us("o_orderdate", 2),
        "INITIAL_PAY": F.lit("1"),
        "TOTAL_PAID_WITH_ADJUSTMENTS_15D": F.lit("2"),
    }
    columns = [value.cast("string").alias(name) for name, value in text.items()]
    return _lines_with_orders(spark, sf).select(*columns, F.trunc("l_shipdate", "year").alias("snapshot_date"))


def write_snapshot_files(raw: DataFrame, root: str) -> None:
    """Text rows as one folder of compressed CSV parts per snapshot date, named as the reader expects.

    Snapshots are few, so every task writes a part of each, without a shuffle or a sort.
    """
    name = F.concat(F.lit("Credit_Data_-_"), F.date_format("snapshot_date", "dd-MM-yyyy"), F.lit(".csv"))
    dated = raw.withColumn("export", name).drop("snapshot_date")
    writer = dated.write.mode("append").option("header", True).option("escape", '"').option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").partitionBy("export").csv(root)


def write_credit_files(spark: SparkSession, sf: str, root: str) -> None:
    """The raw snapshots as files."""
    write_snapshot_files(raw_credit(spark, sf), root)


def _loan_text(column: str) -> Column:
    return F.concat(F.lit("loan-"), F.col(column).cast("string"))


def raw_customer_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four customer tables with copies, conflicts, unusable keys and odd headers."""
    lines, events = table(spark, sf, "lineitem"), table(spark, sf, "events")
    quantity, flag, kind = F.col("l_quantity"), F.col("l_returnflag"), F.col("event_type")
    loan = _loan_text("l_orderkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("event_id") % 20000).cast("int")).cast("string")
    zoned = kind.isin("purchase", "click")
    return {
        "sales": lines.select(
            F.when(quantity != 50, loan).alias("Loan Id"),
            flag.alias("SALE_TYPE"),
            F.col("l_linestatus").alias("SELLER TYPE"),
        ),
        "gender": lines.select(
            F.when(quantity == 49, "#N/A").otherwise(loan).alias("Loan Id"),
            F.col("l_linestatus").alias("Citizenship"),
            F.when(flag == "A", "Female").when(flag == "N", "Male").alias("Gender"),
        ),
        "dob": events.select(
            F.col("event_id").cast("string").alias("_id"),
            F.when(kind == "purchase", "TRANSUNION").when(kind == "view", "SMILEID")
            .when(kind == "click", "SPINMOBILE").when(kind == "error", "OTHERBUREAU").alias("provider"),
            F.when(zoned, F.concat(born, F.lit("T00:00:00+03:00")))
            .otherwise(F.concat(born, F.lit(" 00:00:00"))).alias("date_of_birth"),
            _loan_text("user_id").alias("Loan Id "),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("createdAt UTC"),
        ),
        "income": lines.select(
            F.when(quantity == 48, "#N/A").otherwise(loan).alias("Loan Id"),
            F.col("l_linenumber").cast("string").alias("Duration"),
            F.col("l_extendedprice").cast("string").alias("Received"),
        ),
    }


def raw_survey(spark: SparkSession, sf: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    score = F.least(F.lit(12.0), F.floor(value / 5).cast("double"))
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("Submission ID"),
        F.col("event_id").cast("string").alias("Respondent ID"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Submitted at"),
        F.when((kind != "click") | (value >= 10), _loan_text("user_id")).alias("Loan Id"),
        F.when(kind != "signup", score).cast("string").alias(SCORE_HEADER),
        F.concat(F.lit(" line one, "), F.col("props"), F.lit("\nline two ")).alias(REASON_HEADER),
        F.when(kind == "view", "Yes ").otherwise("No").alias(DELAY_HEADER),
        F.when(kind == "error", "Yes").otherwise("No").alias(LOCK_HEADER),
    )


# The same adapters in SQL ---------------------------------------------------------------

CTE = {
    "ls": """ls AS (
  SELECT l_orderkey AS loan_id, CAST(l_linenumber AS BIGINT) AS line_no,
    CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date,
    CAST(l_shipdate AS DATE) AS reporting_date, CAST(o_orderdate AS DATE) AS next_invoice_date,
    l_extendedprice AS balance, l_extendedprice * abs(l_discount) AS arrears,
    l_extendedprice * (1 - abs(l_discount)) AS total_paid, l_extendedprice * (1 + abs(l_tax)) AS total_due_today,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) * 2 ELSE 0 END AS days_past_due,
    CASE WHEN l_returnflag = 'R' AND l_tax >= 0.07 THEN 'Write Off'
         WHEN l_returnflag = 'R' THEN 'Cancelled Returned in 3 mths' ELSE 'Existing Active' END AS account_status_l1,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'PAR 30' WHEN '2' THEN 'PAR 7' WHEN '3' THEN 'Paid Off'
         WHEN '4' THEN 'Unknown' ELSE 'Active' END AS account_status_l2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "lc": """lc AS (
  SELECT o_orderkey AS loan_id, c_custkey AS cust_id,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD'
         THEN DATE '1890-01-01' + CAST((c_custkey * 31) % 42000 AS INTEGER) END AS dob,
    c_acctbal * 100 AS received_total, CAST(c_nationkey AS DOUBLE) AS duration_months,
    CASE WHEN c_nationkey < 10 THEN 'Female' WHEN c_nationkey < 20 THEN 'Male' END AS gender,
    c_mktsegment AS product_name
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')""",
    "dim": """income AS (
  SELECT *, CASE WHEN duration_months > 0 THEN received_total / duration_months END AS avg_monthly_income FROM lc),
dim AS (
  SELECT *, CASE WHEN avg_monthly_income < 0 THEN 'Invalid'
    WHEN avg_monthly_income <= 4999.99 THEN 'Below 5K'
    WHEN avg_monthly_income >= 5000 AND avg_monthly_income <= 9999.99 THEN '5K-10K'
    WHEN avg_monthly_income >= 10000 AND avg_monthly_income <= 19999.99 THEN '10K-20K'
    WHEN avg_monthly_income >= 20000 AND avg_monthly_income <= 29999.99 THEN '20K-30K'
    WHEN avg_monthly_income >= 30000 AND avg_monthly_income <= 49999.99 THEN '30K-50K'
    WHEN avg_monthly_income >= 50000 AND avg_monthly_income <= 99999.99 THEN '50K-100K'
    WHEN avg_monthly_income >= 100000 AND avg_monthly_income <= 149999.99 THEN '100K-150K'
    WHEN avg_monthly_income >= 150000 THEN '150K+' ELSE 'Unknown' END AS avg_monthly_income_band
  FROM income)""",
    "risk": """risk AS (
  SELECT *, CASE
      WHEN account_status_l1 IN ('Write Off', 'Lost Write Off') OR days_past_due >= 90 THEN 'Critical'
      WHEN account_status_l2 = 'Return' OR account_status_l1 LIKE 'Return%'
        OR account_status_l1 LIKE 'Cancelled Returned%' OR account_status_l1 LIKE 'First 2 days Return%' THEN 'Returned'
      WHEN account_status_l2 = 'Paid Off' THEN 'Closed'
      WHEN (days_past_due >= 31 AND days_past_due < 90) OR account_status_l2 IN ('PAR 30', 'FMD') THEN 'High'
      WHEN (days_past_due >= 1 AND days_past_due <= 30) OR account_status_l2 IN ('PAR 7', 'FPD', 'Inactive') THEN 'Medium'
      WHEN days_past_due = 0 AND account_status_l2 = 'Active' THEN 'Low' ELSE 'Unclassified' END AS risk_category,
    CASE WHEN arrears > 0 AND reporting_date > next_invoice_date
         THEN CAST(reporting_date - next_invoice_date AS BIGINT) ELSE 0 END AS days_past_due_derived
  FROM ls)""",
    "fct": """aged AS (
  SELECT risk.*, lc.dob, floor((reporting_date - lc.dob) / 365.25) AS age_at_report
  FROM risk LEFT JOIN lc ON risk.loan_id = lc.loan_id),
fct AS (
  SELECT *, CASE WHEN age_at_report IS NULL THEN 'Unknown' WHEN age_at_report < 18 THEN 'Under 18'
    WHEN age_at_report <= 25 THEN '18-25' WHEN age_at_report <= 35 THEN '26-35' WHEN age_at_report <= 45 THEN '36-45'
    WHEN age_at_report <= 55 THEN '46-55' WHEN age_at_report <= 100 THEN '55+' ELSE 'Over 100' END AS age_band
  FROM aged)""",
    "sv": """sv AS (
  SELECT event_id AS respondent_id, user_id AS loan_id,
    CASE WHEN event_type <> 'signup' THEN least(12.0, floor(value / 5)) END AS nps_score,
    CASE WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END AS phone_locked_despite_payment,
    CASE WHEN event_type = 'view' THEN 'Yes' ELSE 'No' END AS experienced_payment_delay, event_type
  FROM events)""",
    "nps": """nps AS (
  SELECT *, CASE WHEN nps_score >= 9 THEN 'Promoter' WHEN nps_score >= 7 THEN 'Passive' ELSE 'Detractor' END AS nps_segment
  FROM sv WHERE loan_id IS NOT NULL AND nps_score IS NOT NULL)""",
    "raw": """raw AS (
  SELECT l.*, o.*,
    CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date, ls1.*
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey, LATERAL (SELECT
    CASE WHEN l_quantity IN (49, 50) THEN NULL ELSE 'loan-' || l_orderkey || '-' || l_linenumber END AS loan_id,
    CASE WHEN l_quantity IN (46, 47) THEN NULL ELSE CAST(l_shipdate AS DATE) END AS reporting_date,
    CASE WHEN l_quantity = 45 THEN 'Demo' WHEN l_quantity = 43 THEN 'demo'
         WHEN l_returnflag = 'R' AND l_tax >= 0.07 THEN 'Write Off'
         WHEN l_returnflag = 'R' THEN 'Cancelled Returned in 3 mths' ELSE 'Existing Active' END AS account_status_l1,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'PAR 30' WHEN '2' THEN 'PAR 7' WHEN '3' THEN 'Paid Off'
         WHEN '4' THEN 'Unknown' ELSE 'Active' END AS account_status_l2) ls1)""",
    "clean": """clean AS (
  SELECT loan_id, reporting_date, l_suppkey AS customer_age, l_extendedprice * (1 - abs(l_discount)) AS total_paid,
    CASE WHEN l_quantity <> 44 THEN l_extendedprice * (1 + abs(l_tax)) END AS total_due_today,
    l_extendedprice AS balance,
    CAST(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) * 2 ELSE 0 END AS DOUBLE) AS days_past_due,
    l_extendedprice AS closing_balance, CAST(0 AS DOUBLE) AS advance, l_extendedprice - o_totalprice AS balance_due_to_date,
    l_extendedprice * abs(l_discount) AS arrears,
    CASE l_returnflag WHEN 'R' THEN 'arrears' WHEN 'A' THEN 'up to date' ELSE 'advance' END AS balance_due_status,
    l_quantity AS payment, CAST(l_partkey AS DOUBLE) AS expected_payment, CAST(0 AS DOUBLE) AS first_payment,
    CAST(0 AS DOUBLE) AS first_expected_payment, account_status_l1, account_status_l2,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS return_date, CAST(o_orderdate AS DATE) AS sale_date,
    o_orderstatus AS credit_check_done, CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS payment_amount,
    CAST(NULL AS DOUBLE) AS adjustment_amount, CAST(0 AS DOUBLE) AS prepayment_amount, abs(l_tax) * 100 AS deposit,
    abs(l_tax) AS weekly_rate, CAST(o_orderdate AS DATE) AS credit_expiry, CAST(o_orderdate AS DATE) AS next_invoice_date,
    abs(l_discount) AS discount, CAST(0 AS DOUBLE) AS overpayment_amount, CAST(o_orderdate AS DATE) AS max_payment_date,
    CAST(1 AS DOUBLE) AS initial_pay, CAST(2 AS DOUBLE) AS total_paid_with_adjustments_15d, snapshot_date
  FROM raw WHERE loan_id IS NOT NULL AND lower(account_status_l1) <> 'demo')""",
    "sales": """sales AS (
  SELECT loan_id, sale_type, seller_type FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY sale_type, seller_type) AS place FROM (
      SELECT DISTINCT 'loan-' || l_orderkey AS loan_id, l_returnflag AS sale_type, l_linestatus AS seller_type
      FROM lineitem WHERE l_quantity <> 50) AS one) AS ranked WHERE place = 1)""",
    "gender": """gender AS (
  SELECT loan_id, citizenship, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY citizenship, gender NULLS LAST) AS place FROM (
      SELECT 'loan-' || l_orderkey AS loan_id, l_linestatus AS citizenship,
        CASE l_returnflag WHEN 'A' THEN 'Female' WHEN 'N' THEN 'Male' END AS gender
      FROM lineitem WHERE l_quantity <> 49) AS one) AS ranked WHERE place = 1)""",
    "dob": """dob AS (
  SELECT loan_id, dob, provider FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY CASE provider WHEN 'TRANSUNION' THEN 0
        WHEN 'SMILEID' THEN 1 WHEN 'SPINMOBILE' THEN 2 ELSE 99 END, created_at DESC, dob, provider NULLS LAST) AS place
    FROM (SELECT 'loan-' || user_id AS loan_id, date_trunc('second', ts) AS created_at,
        CASE event_type WHEN 'purchase' THEN 'TRANSUNION' WHEN 'view' THEN 'SMILEID' WHEN 'click' THEN 'SPINMOBILE'
          WHEN 'error' THEN 'OTHERBUREAU' END AS provider,
        TIMESTAMP '1950-01-01 00:00:00' + to_days(CAST(event_id % 20000 AS INTEGER))
          - to_hours(CASE WHEN event_type IN ('purchase', 'click') THEN 3 ELSE 0 END) AS dob
      FROM events) AS parsed) AS ranked WHERE place = 1)""",
    "incomes": """incomes AS (
  SELECT loan_id, duration_months, received_total FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY duration_months DESC, received_total DESC) AS place FROM (
      SELECT 'loan-' || l_orderkey AS loan_id, CAST(l_linenumber AS DOUBLE) AS duration_months,
        l_extendedprice AS received_total FROM lineitem WHERE l_quantity <> 48) AS one) AS ranked WHERE place = 1)""",
}

_PRICE, _DISCOUNT, _TAX = "l_extendedprice", "abs(l_discount)", "abs(l_tax)"
_LOAN = "'loan-' || l_orderkey || '-' || l_linenumber"

# The raw text columns in SQL over the "raw" adapter, numbers as numbers.
RAW_TEXT = {
    "LOAN_ID": f"CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity = 49 THEN '#N/A' WHEN l_quantity = 48 THEN chr(9) || ' ' || {_LOAN} || '  ' ELSE {_LOAN} END",
    "DATE": "CASE WHEN l_quantity = 47 THEN '13/45/2020' WHEN l_quantity = 46 THEN '00:00.0' ELSE strftime(l_shipdate, '%-m/%-d/%Y') END",
    "BALANCE_DUE_STATUS": "CASE l_returnflag WHEN 'R' THEN 'Arrears' WHEN 'A' THEN ' up to date' ELSE 'Advance ' END",
    "ACCOUNT_STATUS_L1": "CASE l_quantity WHEN 45 THEN 'Demo' WHEN 43 THEN ' demo ' ELSE account_status_l1 END",
    "ACCOUNT_STATUS_L2": "account_status_l2",
    "RETURN_DATE": "CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%-m/%-d/%Y') END",
    "SALE_DATE": "strftime(o_orderdate, '%-m/%-d/%Y')",
    "CREDIT_CHECK_DONE": "o_orderstatus",
    "CREDIT_EXPIRY": "strftime(o_orderdate, '%-m/%-d/%Y')",
    "NEXT_INVOICE_DATE": "strftime(o_orderdate, '%-m/%-d/%Y')",
    "MAX_PAYMENT_DATE": "strftime(o_orderdate, '%m/%d/%Y')",
}
RAW_WHOLE = {
    "CUSTOMER_AGE": "l_suppkey", "ADVANCE": "0", "EXPECTED_PAYMENT": "l_partkey", "FIRST_PAYMENT": "0", "FIRST_EXPECTED_PAYMENT": "0",
    "PREPAYMENT_AMOUNT": "0", "INITIAL_PAY": "1", "TOTAL_PAID_WITH_ADJUSTMENTS_15D": "2",
}
RAW_NUMBER = {
    "TOTAL_PAID": f"{_PRICE} * (1 - {_DISCOUNT})", "TOTAL_DUE_TODAY": f"CASE WHEN l_quantity <> 44 THEN {_PRICE} * (1 + {_TAX}) END",
    "BALANCE": _PRICE, "DAYS_PAST_DUE": "CASE WHEN l_linestatus = 'O' THEN l_quantity * 2 ELSE 0 END", "CLOSING_BALANCE": _PRICE,
    "BALANCE_DUE_TO_DATE": f"{_PRICE} - o_totalprice", "ARREARS": f"{_PRICE} * {_DISCOUNT}", "PAYMENT": "l_quantity",
    "PAYMENT_AMOUNT": "CASE WHEN l_returnflag <> 'A' THEN l_quantity END", "ADJUSTMENT_AMOUNT": "NULL", "DEPOSIT": f"{_TAX} * 100",
    "WEEKLY_RATE": _TAX, "DISCOUNT": _DISCOUNT, "OVERPAYMENT_AMOUNT": "0",
}

NEEDS = {"dim": ["lc"], "risk": ["ls"], "fct": ["risk", "lc"], "nps": ["sv"], "clean": ["raw"]}


def using(*names: str) -> str:
    """A WITH clause that defines the named adapters and what they build on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(CTE[name] for name in order) + "\n"


def sql_round(expression: str, digits: int) -> str:
    """Rounding half up on the decimal form, as the Spark side does."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 10)), {digits}) AS DOUBLE)"


def sql_day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"
