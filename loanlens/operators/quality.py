"""Data-quality checks.

Every check reduces the data to counts inside Spark; only finished result rows remain.
The suite reads the fact once for all per-snapshot statistics, once for key uniqueness
and once, keys only, for referential integrity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.rates import tally
from loanlens.functions.values import full_days
from loanlens.operators.cleaning import col, date_agreement
from loanlens.operators.keys import has, key_presence, orphan_counts
from loanlens.schemas import CREDIT_COLUMNS, EXPECTED_CREDIT_COLUMNS, NULL_TOLERANCES
from loanlens.sources.snapshots import union_by_name

# Severity and cadence of each check in the suite.
CHECKS = {
    "schema_and_freshness": ("critical", "real_time"),
    "uniqueness_loan_snapshot": ("critical", "daily"),
    "referential_integrity": ("warning", "daily"),
    "range_checks": ("warning", "daily"),
    "null_thresholds": ("warning", "daily"),
    "dpd_reconciliation": ("info", "weekly"),
}

# Bounds of the range checks and of the days-past-due reconciliation.
AGE_FROM, AGE_TO = 18, 100
SCORE_FROM, SCORE_TO = 0, 10
WITHIN_DAYS, WITHIN_PERCENT = 7, 50

# Which source refers to which.
REFERENCES = [("credit", "customer"), ("nps", "customer"), ("nps", "credit")]

# Where a failed check is sent, by severity.
ROUTES = {"critical": "page", "warning": "chat", "info": "digest"}


def missing_columns(df: DataFrame, expected: list[str] | None = None) -> list[str]:
    return sorted(set(expected or EXPECTED_CREDIT_COLUMNS) - set(df.columns))


def raw_manifest(spark: SparkSession, columns: dict[str, list[str]]) -> DataFrame:
    """(snapshot_date, raw_column): what the files of each snapshot hold, before any of it is staged."""
    rows = [(snapshot, name) for snapshot, held in columns.items() for name in held]
    return spark.createDataFrame(rows, "snapshot_date string, raw_column string")


def schema_contract(manifest: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """One row per snapshot and raw column that it lacks; extra columns are fine.

    Without any snapshot there is one row with neither, for that is a failure too.
    """
    wanted = expected or [header for header, _, _ in CREDIT_COLUMNS]
    held = manifest.groupBy("snapshot_date").agg(F.collect_set("raw_column").alias("held"))
    lacking = F.explode(F.array_except(F.array(*[F.lit(name) for name in wanted]), F.col("held")))
    missing = held.select("snapshot_date", lacking.alias("missing_column"))
    none = manifest.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    text = F.lit(None).cast("string")
    return missing.unionByName(none.select(text.alias("snapshot_date"), text.alias("missing_column")))


def date_mismatches(df: DataFrame) -> DataFrame:
    """Snapshots that do not carry exactly their own date as reporting date."""
    return date_agreement(df).filter("verdict <> 'agrees'")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with all their rows counted."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def uniqueness(df: DataFrame, *keys: str, by: str = "snapshot_date") -> DataFrame:
    """Rows that share their key with another row, per snapshot."""
    return duplicate_keys(df, *keys, by).groupBy(by).agg(F.sum("n_rows").alias("n_dupes"))


def orphans(key: str = "loan_id", **frames: DataFrame) -> DataFrame:
    """All keys that a source has and the one it refers to lacks: (source, missing_in, key).

    Credit and survey refer to customers, the survey to credit too; keys are counted once
    for all pairs.
    """
    presence = key_presence(**{name: (df, key) for name, df in frames.items()})
    pairs = F.array(*[
        F.struct(F.lit(a).alias("source"), F.lit(b).alias("missing_in"), (has(a) & ~has(b)).alias("orphan")) for a, b in REFERENCES
    ])
    return presence.select(F.col("key").alias(key), F.inline(pairs)).filter("orphan").select("source", "missing_in", key)


def age_out_of_range(dob: Column, as_of: Column) -> Column:
    """Age by exact days at the given date outside the accepted range; no date passes."""
    years = full_days(dob, as_of) / F.lit(365.25)
    return (years < AGE_FROM) | (years > AGE_TO)


def _customer_ranges(dim: DataFrame, as_of: Column) -> DataFrame:
    return dim.agg(
        tally(age_out_of_range(F.col("dob"), as_of)).alias("age_bounds"),
        tally(F.col("received_total") <= 0).alias("income_positive"),
    )


def _survey_ranges(nps: DataFrame) -> DataFrame:
    score = F.col("nps_score")
    return nps.agg(tally((score < SCORE_FROM) | (score > SCORE_TO)).alias("nps_score_range"))


def _long(one_row: DataFrame, name: str, value: str) -> DataFrame:
    return one_row.unpivot([], one_row.columns, name, value)


def range_counts(dim: DataFrame, nps: DataFrame, fct: DataFrame, as_of: Column) -> DataFrame:
    """(check, n_failed) for each range rule."""
    credit = fct.agg(tally(F.col("days_past_due") < 0).alias("dpd_non_negative"))
    parts = (_customer_ranges(dim, as_of), _survey_ranges(nps), credit)
    return union_by_name([_long(part, "check", "n_failed") for part in parts])


def null_shares(fct: DataFrame, tolerances: dict[str, float] | None = None) -> DataFrame:
    """Null share per snapshot and watched column; a column that is absent counts as null."""
    limits = tolerances or NULL_TOLERANCES
    shares = fct.groupBy(F.col("snapshot_date")).agg(
        *[
            (tally(col(c).isNull()) / F.count(F.lit(1)) if c in fct.columns else F.lit(1.0)).alias(f"null_{c}")
            for c in limits
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"null_{c}").alias("null_share"),
            F.lit(limit).cast("double").alias("tolerance"),
            F.lit("null_share" if c in fct.columns else "missing_column").alias("issue"),
        )
        for c, limit in limits.items()
    ]
    return shares.select("snapshot_date", F.inline(F.array(*rows)))


def null_breaches(fct: DataFrame, tolerances: dict[str, float] | None = None) -> DataFrame:
    over = (F.col("null_share") > F.col("tolerance")) | (F.col("issue") == "missing_column")
    return null_shares(fct, tolerances).filter(over).select(
        "snapshot_date",
        "column",
        "issue",
        F.round(F.col("null_share") * 100, 2).alias("pct_null"),
        F.round(F.col("tolerance") * 100, 2).alias("pct_tolerated"),
    )


def dpd_reconciliation(fct: DataFrame) -> DataFrame:
    """Agreement of source and derived days past due per snapshot, in percent.

    Pairs with a null on either side count as rows but not in the percentages.
    """
    gap = F.abs(F.col("days_past_due_derived") - F.col("days_past_due"))

    def pct(condition: Column) -> Column:
        return F.round(F.try_divide(tally(condition) * F.lit(100.0), F.count(gap).cast("double")), 2)

    return (
        fct.groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            pct(gap == 0).alias("exact_match_pct"),
            pct(gap <= WITHIN_DAYS).alias("within_7d_pct"),
        )
        .withColumn("breached", F.coalesce(F.col("within_7d_pct") < WITHIN_PERCENT, F.lit(False)))
    )


def _snapshot_measures(fct: DataFrame) -> DataFrame:
    """All per-snapshot statistics of the suite in one pass, reduced to one row."""
    gap = F.abs(F.col("days_past_due_derived") - F.col("days_past_due"))
    per_snapshot = fct.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("reporting_date").alias("first_date"),
        F.max("reporting_date").alias("last_date"),
        tally(F.col("days_past_due") < 0).alias("negative_dpd"),
        tally(gap == 0).alias("exact"),
        tally(gap <= WITHIN_DAYS).alias("within"),
        F.count(gap).alias("pairs"),
        *[tally(col(c).isNull()).alias(f"null_{c}") for c in NULL_TOLERANCES if c in fct.columns],
    )
    breaches = sum(
        (
            F.when(F.col(f"null_{c}") / F.col("n") > limit, 1).otherwise(0)
            if c in fct.columns
            else F.lit(1)
        )
        for c, limit in NULL_TOLERANCES.items()
    )

    def pct(part: str) -> Column:
        return F.round(F.try_divide(F.col(part) * F.lit(100.0), F.col("pairs").cast("double")), 2)

    agrees = (F.col("first_date") == F.col("last_date")) & (F.col("first_date") == F.col("snapshot_date"))
    line = F.struct(
        F.col("snapshot_date").cast("string").alias("snapshot_date"), F.col("n").alias("rows"),
        pct("exact").alias("exact_match_pct"), pct("within").alias("within_7d_pct"),
    )
    return per_snapshot.agg(
        F.count(F.lit(1)).alias("snapshots"),
        tally(~F.coalesce(agrees, F.lit(False))).alias("date_mismatches"),
        F.coalesce(F.sum("negative_dpd"), F.lit(0)).alias("negative_dpd"),
        F.coalesce(F.sum(breaches), F.lit(0)).cast("bigint").alias("null_breaches"),
        tally(pct("within") < WITHIN_PERCENT).alias("dpd_breaches"),
        # One short entry per snapshot, so the list is as long as the list of snapshots.
        F.to_json(F.array_sort(F.collect_list(line))).alias("dpd_lines"),
    )


def _result(name: str, n_failed: Column, detail: Column) -> Column:
    severity, cadence = CHECKS[name]
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        F.lit(cadence).alias("cadence"),
        (n_failed == 0).alias("passed"),
        n_failed.cast("bigint").alias("n_failed"),
        detail.alias("detail"),
    )


def run_suite(
    fct: DataFrame, dim: DataFrame, nps: DataFrame, as_of: Column,
    unique_on: tuple[str, ...] = ("loan_id",), incomplete_snapshots: int | None = None,
) -> DataFrame:
    """One result row per check, all from one plan; ``detail`` is JSON.

    ``incomplete_snapshots`` is the number of snapshots whose raw files miss a column, as the
    contract found it; without it the columns of ``fct`` decide for all.
    """
    stats = _snapshot_measures(fct)
    numbers = ["snapshots", "date_mismatches", "negative_dpd", "null_breaches", "dpd_breaches"]
    dupes = duplicate_keys(fct, *unique_on, "snapshot_date").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows")
    )
    orphans = orphan_counts(
        key_presence(credit=(fct, "loan_id"), customer=(dim, "loan_id"), nps=(nps, "loan_id")),
        REFERENCES,
    )
    counted = [_long(part, "measure", "n") for part in
               (dupes, orphans, _customer_ranges(dim, as_of), _survey_ranges(nps))]
    noted = stats.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("measure"), F.col(n).alias("n"), F.col("dpd_lines").alias("note")) for n in numbers
    ])))
    measures = union_by_name([noted, *counted])

    if incomplete_snapshots is None:
        incomplete = F.col("snapshots") * F.lit(1 if missing_columns(fct) else 0)
    else:
        incomplete = F.lit(incomplete_snapshots)
    names = [*numbers, "duplicate_rows", *orphans.columns, "age_bounds", "income_positive", "nps_score_range"]
    row = measures.agg(
        *[F.max(F.when(F.col("measure") == m, F.col("n"))).alias(m) for m in names], F.max("note").alias("dpd_lines")
    )
    n = {m: F.col(m) for m in names}

    def say(*measures: str, **renamed: str) -> Column:
        """The named measures as a JSON object."""
        return F.to_json(F.struct(*[n[m] for m in measures], *[n[m].alias(name) for name, m in renamed.items()]))

    # No snapshot at all is one failure.
    freshness = incomplete + n["date_mismatches"] + F.when(n["snapshots"] == 0, 1).otherwise(0)
    out_of_range = n["age_bounds"] + n["income_positive"] + n["nps_score_range"] + n["negative_dpd"]
    return row.select(F.inline(F.array(
        _result("schema_and_freshness", freshness, say("snapshots", "date_mismatches")),
        _result("uniqueness_loan_snapshot", n["duplicate_rows"], say("duplicate_rows")),
        _result(
            "referential_integrity",
            n["credit_not_in_customer"] + n["nps_not_in_customer"],
            say("credit_not_in_customer", "nps_not_in_customer", "nps_not_in_credit"),
        ),
        _result(
            "range_checks",
            out_of_range,
            say("age_bounds", "income_positive", "nps_score_range", dpd_non_negative="negative_dpd"),
        ),
        _result("null_thresholds", n["null_breaches"], say("null_breaches", "snapshots")),
        _result("dpd_reconciliation", n["dpd_breaches"], F.col("dpd_lines")),
    )))


def with_routes(results: DataFrame) -> DataFrame:
    """Where each failed check goes; passed checks go nowhere."""
    route = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])[F.col("severity")]
    return results.withColumn("route", F.when(~F.col("passed"), route))


def gate(results: DataFrame) -> DataFrame:
    """One row: did a critical check fail?  The caller decides whether that stops a run."""
    failed = ~F.col("passed") & (F.col("severity") == "critical")
    return results.agg(tally(failed).alias("n_critical"), F.coalesce(F.max(failed), F.lit(False)).alias("blocked"))
