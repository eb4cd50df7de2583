"""Fixed values of the data contract: columns, tolerances, tokens, ranks, headers."""

from __future__ import annotations

# Raw header, staged name, kind of every credit snapshot column.
CREDIT_COLUMNS = [
    ("LOAN_ID", "loan_id", "text"),
    ("DATE", "reporting_date", "date"),
    ("CUSTOMER_AGE", "customer_age", "long"),
    ("TOTAL_PAID", "total_paid", "double"),
    ("TOTAL_DUE_TODAY", "total_due_today", "double"),
    ("BALANCE", "balance", "double"),
    ("DAYS_PAST_DUE", "days_past_due", "double"),
    ("CLOSING_BALANCE", "closing_balance", "double"),
    ("ADVANCE", "advance", "double"),
    ("BALANCE_DUE_TO_DATE", "balance_due_to_date", "double"),
    ("ARREARS", "arrears", "double"),
    ("BALANCE_DUE_STATUS", "balance_due_status", "text"),
    ("PAYMENT", "payment", "double"),
    ("EXPECTED_PAYMENT", "expected_payment", "double"),
    ("FIRST_PAYMENT", "first_payment", "double"),
    ("FIRST_EXPECTED_PAYMENT", "first_expected_payment", "double"),
    ("ACCOUNT_STATUS_L1", "account_status_l1", "text"),
    ("ACCOUNT_STATUS_L2", "account_status_l2", "text"),
    ("RETURN_DATE", "return_date", "date"),
    ("SALE_DATE", "sale_date", "date"),
    ("CREDIT_CHECK_DONE", "credit_check_done", "text"),
    ("PAYMENT_AMOUNT", "payment_amount", "double"),
    ("ADJUSTMENT_AMOUNT", "adjustment_amount", "double"),
    ("PREPAYMENT_AMOUNT", "prepayment_amount", "double"),
    ("DEPOSIT", "deposit", "double"),
    ("WEEKLY_RATE", "weekly_rate", "double"),
    ("CREDIT_EXPIRY", "credit_expiry", "date"),
    ("NEXT_INVOICE_DATE", "next_invoice_date", "date"),
    ("DISCOUNT", "discount", "double"),
    ("OVERPAYMENT_AMOUNT", "overpayment_amount", "double"),
    ("MAX_PAYMENT_DATE", "max_payment_date", "date"),
    ("INITIAL_PAY", "initial_pay", "double"),
    ("TOTAL_PAID_WITH_ADJUSTMENTS_15D", "total_paid_with_adjustments_15d", "double"),
]

# Headers without which a snapshot cannot be used.
CREDIT_KEY, CREDIT_STATUS = "LOAN_ID", "ACCOUNT_STATUS_L1"

# The staged table must hold every staged name plus the partition column.
EXPECTED_CREDIT_COLUMNS = [staged for _, staged, _ in CREDIT_COLUMNS] + ["snapshot_date"]

# Texts a data-frame reader takes for "no value" by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the literal that marks a key which could not be looked up.
UNRESOLVED_KEY = "#N/A"

# Trust order of the date-of-birth providers; any other provider ranks last.
PROVIDER_RANK = {"TRANSUNION": 0, "SMILEID": 1, "SPINMOBILE": 2}
OTHER_PROVIDER_RANK = 99

# Highest share of nulls accepted per column and snapshot.
NULL_TOLERANCES = {
    "loan_id": 0.00,
    "reporting_date": 0.00,
    "balance": 0.01,
    "account_status_l2": 0.01,
    "next_invoice_date": 0.20,
    "sale_date": 0.05,
}

# Tables of the customer source and the key header they share once stripped.
CUSTOMER_TABLES = {
    "sales": "Sales Details",
    "gender": "Gender",
    "dob": "DOB",
    "income": "Income Level",
}
CUSTOMER_KEY = "Loan Id"

# Plain survey headers, then the question headers.
SURVEY_HEADERS = {
    "Submission ID": "submission_id",
    "Respondent ID": "respondent_id",
    "Submitted at": "submitted_at",
    "Loan Id": "loan_id",
}
# Whole headers, lower-case and without the question mark; names of the seller are left open.
SURVEY_QUESTIONS = {
    "are you happy with the quality and performance of your device": "happy_with_device",
    "are you happy with the service and support provided by .+": "happy_with_service",
    "have you ever experienced a delay in your payment reflecting in your (?:\\S+ )?account": "experienced_payment_delay",
    "have you ever had difficulty getting assistance from .+ customer support when needed": "difficulty_getting_support",
    "have you experienced any battery-related issues with your .+ device": "battery_issues",
    "have you used the .+ to manage your account or make payments": "uses_app",
    "which communication channel do you prefer when contacting .+ for inquiries or support": "preferred_channel",
    "have you ever had your phone lock despite making a payment on time": "phone_locked_despite_payment",
}
SURVEY_SCORE_STEM = "scale from 0"
