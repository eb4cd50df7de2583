"""The stages as plain functions; each reads and writes tables below one warehouse folder.

A stage can be run again at any time: staged tables and facts are replaced (facts one
partition at a time), only the check log grows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.values import null_if_token, number
from loanlens.operators import keys, metrics, profiling, quality
from loanlens.operators.quantiles import summary
from loanlens.plans import marts, staging
from loanlens.schemas import CREDIT_KEY, CREDIT_STATUS, CUSTOMER_KEY
from loanlens.sources import snapshots, tables
from loanlens.sources.first_lines import Part

# Enum columns that are listed, and the sources whose keys are compared.
VOCABULARIES = ["ACCOUNT_STATUS_L1", "ACCOUNT_STATUS_L2", "BALANCE_DUE_STATUS", "CREDIT_CHECK_DONE"]
RELATIONS = [("credit", "sales"), ("credit", "gender"), ("credit", "dob"), ("credit", "income"), ("nps", "credit")]


@dataclass(frozen=True)
class Inputs:
    """Where the raw data lies: a glob of snapshot files, a folder of tables, a survey."""

    snapshots: str
    customers: str
    survey: str


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))


def exports_of(spark: SparkSession, inputs: Inputs) -> list[Part]:
    """The snapshot exports with their headers; no file, or one without key or status, stops the run."""
    exports = snapshots.find_snapshots(spark, inputs.snapshots)
    if not exports:
        raise ValueError(f"no snapshot files match {inputs.snapshots}")
    snapshots.require_columns(exports, CREDIT_KEY, CREDIT_STATUS)
    return exports


def profile(
    spark: SparkSession, inputs: Inputs, out: Warehouse, as_of: Column | None = None, exports: list[Part] | None = None,
    customers: dict[str, DataFrame] | None = None,
) -> None:
    """Profiles of every raw source: columns, sizes, relations, vocabularies, numbers, years and outliers.

    The raw book is counted once, by snapshot, column and value; that table is kept as
    ``raw_values``, a folder per column, and everything about the book is taken from it.
    ``as_of`` is the date at which implied ages are taken, the newest reported one if not given.
    """
    exports = exports or exports_of(spark, inputs)
    customers = customers or tables.read_customer_tables(spark, inputs.customers)
    credit = snapshots.read_snapshots(spark, exports)
    tables.write_partitions(profiling.column_values(credit, by=["snapshot_date"]), out.path("raw_values"), by="column")
    values = out.read(spark, "raw_values").withColumn("column", F.col("column").cast("string"))
    held = quality.raw_manifest(spark, snapshots.manifest(exports)).select(
        F.col("snapshot_date").cast("date").alias("snapshot_date"), F.col("raw_column").alias("column")
    )
    survey = tables.read_survey(spark, inputs.survey)
    named = staging.rename_survey(survey)
    income = staging.typed_income(customers["income"])
    dob = staging.typed_dob(customers["dob"])

    def of(header: str) -> DataFrame:
        return values.filter(F.col("column") == header)

    if as_of is None:
        as_of = of("DATE").agg(F.max(staging.PARSERS["date"](F.col("value")))).scalar()
    loans = of(CREDIT_KEY).groupBy(F.col("value").alias(CREDIT_KEY)).agg(F.sum("n").alias("n"))
    presence = keys.key_presence(
        credit=(loans, CREDIT_KEY, "n"), nps=(survey, CUSTOMER_KEY), **{name: (df, CUSTOMER_KEY) for name, df in customers.items()}
    )
    survey_score = named.select(number(F.col("nps_score").cast("string")).alias("nps_score"))
    overdue = of("DAYS_PAST_DUE").select(
        F.lit("days_past_due").alias("name"), staging.PARSERS["double"](F.col("value")).alias("value"), "n"
    )
    overdue = overdue.groupBy("name", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.sum("n").alias("n"))
    size = of(CREDIT_KEY).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    size = size.select(F.lit("credit").alias("dataset"), "rows", F.lit(len(credit.columns)).cast("bigint").alias("cols"))
    results = {
        "profile_credit": profiling.profile_of_values(values, "credit", by="snapshot_date", held=held),
        "profile_customer": snapshots.union_by_name(
            [profiling.raw_profile(df, f"customer::{name}") for name, df in customers.items()]
        ),
        "profile_nps": profiling.raw_profile(survey, "nps"),
        "dataset_summary": size.unionByName(profiling.dataset_summary(nps=survey, **customers)),
        "relationships": keys.relationship_metrics(
            presence, unresolved=["gender", "income", "dob"], pairs=RELATIONS, duplicates=list(customers),
            sources=["credit", *customers, "nps"],
        ),
        "vocabulary": profiling.vocabulary_of_values(values.withColumn("value", null_if_token(F.col("value"))), VOCABULARIES),
        "status_counts": profiling.counts_of_values(values, VOCABULARIES),
        "numeric_summary": snapshots.union_by_name([
            summary(overdue).withColumnRenamed("name", "column"),
            profiling.numeric_summary(income, ["received_total", "duration_months"]),
            profiling.numeric_summary(survey_score, ["nps_score"]),
        ]),
        "birth_years": profiling.year_histogram(dob, "dob"),
        "outliers": profiling.outlier_counts(dob, income, survey_score, as_of),
    }
    for name, frame in results.items():
        tables.write_result(frame, out.path(name))


def stage(
    spark: SparkSession, inputs: Inputs, out: Warehouse, exports: list[Part] | None = None, customers: dict[str, DataFrame] | None = None
) -> None:
    """Clean the raw sources.  Snapshot files hold one date each, so no shuffle is needed.

    The job that writes the staged book also counts what it drops and what it cannot parse.
    What each snapshot's files held is kept beside the tables, for the schema check.
    """
    exports = exports or exports_of(spark, inputs)
    customers = customers or tables.read_customer_tables(spark, inputs.customers)
    tables.write_table(quality.raw_manifest(spark, snapshots.manifest(exports)), out.path("raw_manifest"))
    account = staging.Account(snapshots.read_each(spark, exports))
    tables.write_partitions(account.staged, out.path("stg_credit_snapshot"), rebalance=False)
    tables.write_result(account.losses(spark), out.path("parse_losses"))
    tables.write_table(staging.clean_customer(**customers), out.path("stg_customer"))
    survey = tables.read_survey(spark, inputs.survey)
    tables.write_table(staging.clean_survey(survey), out.path("stg_nps"))

    def report(source: str, counts: DataFrame) -> DataFrame:
        return counts.select(F.lit(source).alias("source"), "metric", F.col("value").cast("double").alias("value"))

    def per_snapshot(counts: DataFrame) -> DataFrame:
        return counts.select(
            F.concat(F.lit("credit::"), F.col("snapshot_date").cast("string")).alias("source"),
            "metric",
            F.col("value").cast("double").alias("value"),
        )

    coverage = staging.customer_coverage(out.read(spark, "stg_customer"))
    filled, percent = (
        coverage.select(F.concat(F.lit(word), F.col("column")).alias("metric"), F.col(value).alias("value"))
        for word, value in (("with_", "n_filled"), ("pct_with_", "filled_pct"))
    )
    warnings = quality.date_mismatches(out.read(spark, "stg_credit_snapshot")).select(
        "snapshot_date", F.concat(F.lit("date_warning::"), F.col("verdict")).alias("metric"), F.col("n_dates").alias("value")
    )
    reports = [
        per_snapshot(account.report(out.read(spark, "stg_credit_snapshot"))),
        per_snapshot(warnings),
        report("customer", staging.sales_report(customers["sales"])),
        report("customer", filled),
        report("customer", percent),
        report("nps", staging.survey_report(survey)),
    ]
    tables.write_result(snapshots.union_by_name(reports), out.path("cleaning_report"))


def build_marts(spark: SparkSession, out: Warehouse) -> None:
    customer = out.read(spark, "stg_customer")
    tables.write_table(marts.dim_customer(customer), out.path("dim_customer"))
    fct = marts.fct_credit_snapshot(out.read(spark, "stg_credit_snapshot"), customer)
    tables.write_partitions(fct, out.path("fct_credit_snapshot"))


def check(spark: SparkSession, out: Warehouse, as_of: Column) -> DataFrame:
    """Run all checks, add them to the log and return them with their routes.

    The contract looks at the raw columns; its findings and all orphans are tables of their
    own, and the gate's verdict too.
    """
    manifest = out.read(spark, "raw_manifest")
    contract = quality.schema_contract(manifest)
    tables.write_result(contract, out.path("missing_columns"))
    incomplete = contract.select("snapshot_date").distinct().count()
    frames = {name: out.read(spark, table) for name, table in
              (("credit", "fct_credit_snapshot"), ("customer", "dim_customer"), ("nps", "stg_nps"))}
    tables.write_table(quality.orphans(**frames), out.path("orphans"))
    results = quality.run_suite(frames["credit"], frames["customer"], frames["nps"], as_of, incomplete_snapshots=incomplete)
    run_at = spark.sql("SELECT current_timestamp()").first()[0]
    log = out.path("dq_results")
    tables.append_log(results.withColumn("ts", F.lit(run_at)), log)
    logged = quality.with_routes(spark.read.parquet(log).filter(F.col("ts") == F.lit(run_at)))
    tables.write_result(quality.gate(logged), out.path("gate"))
    return logged


def analyse(spark: SparkSession, out: Warehouse) -> None:
    fct, dim, nps = (out.read(spark, t) for t in ("fct_credit_snapshot", "dim_customer", "stg_nps"))
    segments = metrics.segment_base(fct, dim, income_band="avg_monthly_income_band")
    top_columns = ["loan_id", "snapshot_date", "balance", "arrears", "days_past_due", "account_status_l2",
                   "risk_category", "age_band"]
    attributes = [c for c in ("gender", "avg_monthly_income_band", "product_name") if c in dim.columns]
    results = {
        "snapshot_counts": metrics.snapshot_counts(out.read(spark, "stg_credit_snapshot")),
        "portfolio_metrics": metrics.portfolio_kpis(fct),
        "portfolio_growth": metrics.portfolio_growth(metrics.portfolio_kpis(fct)),
        "portfolio_by_segment": metrics.segment_kpis(segments, "age_band", "income_band"),
        "divergent_segments": metrics.divergent_segments(segments, "age_band", "income_band"),
        "nps_by_risk": metrics.nps_by_risk(metrics.survey_with_credit(nps, fct)),
        "cleaned_summary": metrics.latest_top_exposures(fct, dim, attributes, keep=top_columns),
    }
    for name, frame in results.items():
        tables.write_result(frame, out.path(name))


def run(spark: SparkSession, inputs: Inputs, out: Warehouse, as_of: Column) -> DataFrame:
    """All stages in order; the checks with their routes are the result."""
    exports, customers = exports_of(spark, inputs), tables.read_customer_tables(spark, inputs.customers)
    profile(spark, inputs, out, as_of, exports, customers)
    stage(spark, inputs, out, exports, customers)
    build_marts(spark, out)
    checked = check(spark, out, as_of)
    analyse(spark, out)
    return checked
