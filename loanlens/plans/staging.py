"""Raw inputs to staged tables, each with a report that accounts for every dropped row."""

from __future__ import annotations

import re

from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.bands import nps_segment
from loanlens.functions.rates import tally
from loanlens.functions.values import null_if_token, number, stripped, us_date, whole_number
from loanlens.operators.cleaning import (
    col, drop_blank_rows, drop_null_keys, drop_report, is_test_row, normalise_nulls, split_by_key, trim_strings,
)
from loanlens.operators.dedupe import (
    first_per_key, longest_history, parse_dob_table, resolve_by_provider,
)
from loanlens.operators.metrics import coverage_report
from loanlens.schemas import (
    CREDIT_COLUMNS, CREDIT_KEY, CREDIT_STATUS, CUSTOMER_KEY, SURVEY_HEADERS, SURVEY_QUESTIONS, SURVEY_SCORE_STEM,
)
from loanlens.sources.headers import lower_headers, pick_header, snake_headers, strip_headers
from loanlens.sources.snapshots import union_by_name

# A null token would not parse as a number either, but a failed parse costs far more
# than the look-up.
PARSERS = {
    "text": lambda c: null_if_token(c, then=stripped(c)),
    "date": lambda c: us_date(stripped(c)),
    "double": lambda c: number(null_if_token(c)),
    "long": lambda c: whole_number(null_if_token(c)),
}
SQL_TYPES = {"text": "string", "date": "date", "double": "double", "long": "bigint"}


# Credit snapshots ---------------------------------------------------------------------

# Expressions name their column only, so one serves every snapshot; making one takes a
# hundred calls of the JVM.
@cache
def _parsed(header: str, kind: str) -> Column:
    return PARSERS[kind](col(header).cast("string"))


@cache
def _unread(header: str, kind: str) -> Column:
    text = col(header).cast("string")
    return _parsed(header, kind).isNull() & null_if_token(text).isNotNull() & (F.btrim(text) != "")


def stage_credit_columns(raw: DataFrame, *more: Column) -> DataFrame:
    """Raw text columns to the canonical typed columns, all in one projection.

    Every snapshot gets the same types whatever its file held, so snapshots can be put
    together.  Absent columns become null, unknown ones follow as trimmed text; ``more``
    are further results of the same projection.
    """
    held = set(raw.columns)

    def value(header: str, kind: str) -> Column:
        if header not in held:
            return F.lit(None).cast(SQL_TYPES[kind])
        return _parsed(header, kind)

    known = {header for header, _, _ in CREDIT_COLUMNS} | {"snapshot_date"}
    columns = [value(header, kind).alias(name) for header, name, kind in CREDIT_COLUMNS]
    extra = [PARSERS["text"](col(c).cast("string")).alias(c.lower()) for c in raw.columns if c not in known]
    staged = raw.select(*columns, *extra, "snapshot_date", *more)
    return staged.withColumn("balance_due_status", F.lower("balance_due_status"))


def drop_reason(raw: DataFrame) -> Column:
    """Why a raw row is dropped: test rows first, then rows without key, null for the rest.

    Told from the raw text, so that a row is sorted out before any of it is parsed.
    """
    lacking = [name for name in (CREDIT_STATUS, CREDIT_KEY) if name not in raw.columns]
    if lacking:
        raise ValueError(f"raw rows without required column: {', '.join(lacking)}")
    status, key = col(CREDIT_STATUS), col(CREDIT_KEY)
    return F.when(is_test_row(status), "test_row").when(null_if_token(key).isNull(), "null_key")


def clean_credit_snapshot(raw: DataFrame) -> DataFrame:
    """Staged credit rows; one filter and one projection, no shuffle."""
    return stage_credit_columns(raw.filter(drop_reason(raw).isNull()))


def credit_report(raw: DataFrame) -> DataFrame:
    """Rows in, dropped by reason, out, and distinct loans, per snapshot."""
    tagged = raw.select("snapshot_date", stripped(col("LOAN_ID")).alias("loan_id"), drop_reason(raw).alias("drop_reason"))
    return drop_report(tagged, "snapshot_date", "loan_id", ["test_row", "null_key"])


TYPED = [(header, kind) for header, _, kind in CREDIT_COLUMNS if kind != "text"]


def _lost(raw: DataFrame) -> Column:
    """For each typed column, whether its text is no missing value and yet gave no value.

    The parsed values are those of the staged columns, so the projection parses them once.
    """
    held = set(raw.columns)
    return F.array(*[_unread(header, kind) if header in held else F.lit(False) for header, kind in TYPED])


class Account:
    """What the job that stages snapshots sees of their raw rows, without another pass over them.

    Rows read, dropped by reason, and texts lost in parsing by column are observed as the rows
    pass on to the staged table; rows kept and distinct loans are then read from that table,
    two of its columns.  One observation per snapshot, known once a job has run.
    """

    def __init__(self, raw: Mapping[str, DataFrame]):
        self.observed = {date: Observation(f"snapshot {date}") for date in raw}
        frames = [self._watched(frame, self.observed[date]) for date, frame in raw.items()]
        self.staged = union_by_name(frames)

    @staticmethod
    def _watched(raw: DataFrame, observation: Observation) -> DataFrame:
        tagged = stage_credit_columns(raw, drop_reason(raw).alias("drop_reason"), _lost(raw).alias("lost"))
        counts = [F.count(F.lit(1)).alias("rows_in")]
        counts += [F.count_if(F.col("drop_reason") == reason).alias(f"dropped_{reason}") for reason in ("test_row", "null_key")]
        counts += [F.count_if(F.col("lost")[i]).alias(f"lost::{header}") for i, (header, _) in enumerate(TYPED)]
        return tagged.observe(observation, *counts).filter(F.col("drop_reason").isNull()).drop("drop_reason", "lost")

    def report(self, staged: DataFrame) -> DataFrame:
        """(snapshot_date, metric, value) as in ``credit_report``, given the table that the job wrote."""
        seen = [(date, name, int(value)) for date, o in self.observed.items() for name, value in o.get.items() if not name.startswith("lost::")]
        before = staged.sparkSession.createDataFrame(seen, "snapshot_date string, metric string, value long")
        kept = staged.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows_out"), F.count_distinct("loan_id").alias("unique_keys"))
        dates = staged.sparkSession.createDataFrame([(date,) for date in self.observed], "snapshot_date string")
        after = dates.select(F.col("snapshot_date").cast("date")).join(kept, "snapshot_date", "left").fillna(0)
        after = after.unpivot("snapshot_date", ["rows_out", "unique_keys"], "metric", "value")
        return before.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).unionByName(after)

    def losses(self, spark: SparkSession) -> DataFrame:
        """(snapshot_date, column, n_lost) of every typed column."""
        seen = [(date, name.removeprefix("lost::"), int(n)) for date, o in self.observed.items() for name, n in o.get.items() if name.startswith("lost::")]
        found = spark.createDataFrame(seen, "snapshot_date string, column string, n_lost long")
        return found.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


# Customer tables ----------------------------------------------------------------------

def _keyed(table: DataFrame) -> DataFrame:
    """Stripped headers, no padding rows, usable keys only; values stay untrimmed."""
    return split_by_key(drop_blank_rows(normalise_nulls(strip_headers(table))), CUSTOMER_KEY)[0]


def clean_sales(sales: DataFrame) -> DataFrame:
    """One row per loan; exact copies are just further rows of their loan."""
    return snake_headers(first_per_key(_keyed(sales), [CUSTOMER_KEY]))


def clean_gender(gender: DataFrame) -> DataFrame:
    one = first_per_key(_keyed(gender), [CUSTOMER_KEY])
    return lower_headers(one.withColumnRenamed(CUSTOMER_KEY, "loan_id"))


def typed_dob(dob: DataFrame) -> DataFrame:
    """All rows with a usable key and their parsed dates, copies included."""
    return parse_dob_table(_keyed(dob)).withColumnRenamed(CUSTOMER_KEY, "loan_id")


def clean_dob(dob: DataFrame) -> DataFrame:
    parsed = typed_dob(dob)
    return resolve_by_provider(parsed.select("loan_id", "dob", "provider", "created_at"), "loan_id", "provider", "created_at").drop("created_at")


def typed_income(income: DataFrame) -> DataFrame:
    """All rows with a usable key and their amounts, copies included."""
    return _keyed(income).select(
        col(CUSTOMER_KEY).alias("loan_id"),
        number(col("Duration").cast("string")).alias("duration_months"),
        number(col("Received").cast("string")).alias("received_total"),
    )


def clean_income(income: DataFrame) -> DataFrame:
    return longest_history(typed_income(income), "loan_id", "duration_months", "received_total")


def customer_spine(sales: DataFrame, *attributes: DataFrame) -> DataFrame:
    """Each sales row with the attributes of its loan.

    Every input has one row per loan and comes partitioned by loan from that step, so
    the joins add no shuffle of their own.
    """
    joined = sales
    for table in attributes:
        joined = joined.join(table, "loan_id", "left")
    return joined


def clean_customer(sales: DataFrame, gender: DataFrame, dob: DataFrame, income: DataFrame) -> DataFrame:
    return customer_spine(clean_sales(sales), clean_gender(gender), clean_dob(dob), clean_income(income))


def sales_report(sales: DataFrame) -> DataFrame:
    """(metric, value): rows in, dropped without key, as exact copies, as same loan, out.

    Exact copies are counted before the shuffle, then the distinct rows per loan.
    """
    rows = drop_blank_rows(normalise_nulls(strip_headers(sales)))
    key = col(CUSTOMER_KEY)
    copies = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("_n"))
    loans = copies.groupBy(key).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
    keyed = key.isNotNull()

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    counts = loans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        total(~keyed, F.col("n")).alias("dropped_null_key"),
        total(keyed, F.col("n") - F.col("n_distinct")).alias("dropped_exact_copy"),
        total(keyed, F.col("n_distinct") - 1).alias("dropped_same_loan"),
        tally(keyed).alias("rows_out"),
    )
    return counts.unpivot([], counts.columns, "metric", "value")


def customer_coverage(customer: DataFrame) -> DataFrame:
    return coverage_report(customer, ["gender", "dob", "received_total"])


# Survey -------------------------------------------------------------------------------

def rename_survey(survey: DataFrame) -> DataFrame:
    """Short names for the long question headers; other columns keep theirs.

    A header is matched as a whole, but for case, spacing and the seller's name, so a
    follow-up question keeps its own header; two headers for one short name are an error.
    """
    names = {pick_header(survey, SURVEY_SCORE_STEM): "nps_score"}
    names.update({old: new for old, new in SURVEY_HEADERS.items() if old in survey.columns})
    for pattern, short in SURVEY_QUESTIONS.items():
        matching = [h for h in survey.columns if re.fullmatch(pattern, " ".join(h.lower().split()).rstrip(" ?"))]
        if len(matching) > 1:
            raise ValueError(f"several survey headers for {short}: {', '.join(matching)}")
        names.update({header: short for header in matching})
    return survey.withColumnsRenamed(names)


def tag_survey_rows(survey: DataFrame) -> DataFrame:
    """Renamed, typed and trimmed responses with one flag per missing essential.

    Two flags rather than one reason: a response may lack both.
    """
    named = rename_survey(drop_blank_rows(normalise_nulls(strip_headers(survey))))
    typed = trim_strings(named).withColumn("nps_score", number(F.col("nps_score").cast("string")))
    return typed.withColumn("no_loan", F.col("loan_id").isNull()).withColumn("no_score", F.col("nps_score").isNull())


def clean_survey(survey: DataFrame) -> DataFrame:
    kept = drop_null_keys(tag_survey_rows(survey).drop("no_loan", "no_score"), "loan_id", "nps_score")
    return kept.withColumn("nps_segment", nps_segment(F.col("nps_score")))


def survey_report(survey: DataFrame) -> DataFrame:
    kept = ~F.col("no_loan") & ~F.col("no_score")
    counts = tag_survey_rows(survey).agg(
        F.count(F.lit(1)).alias("rows_in"),
        tally(F.col("no_loan")).alias("without_loan"),
        tally(F.col("no_score")).alias("without_score"),
        tally(kept).alias("rows_out"),
        F.count_distinct(F.when(kept, F.col("loan_id"))).alias("unique_keys"),
    )
    return counts.unpivot([], counts.columns, "metric", "value")
