"""The stages one after the other on raw files written from the given tables."""

import datetime as dt

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from loanlens.plans import pipeline, staging
from loanlens.registry import adapters, q_sources
from loanlens.schemas import CUSTOMER_TABLES
from loanlens.sources import snapshots

AS_OF = dt.date(2001, 12, 30)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    adapters.write_snapshot_files(adapters.raw_credit(spark, SMALL), f"{root}/credit")
    for name, df in adapters.raw_customer_tables(spark, SMALL).items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/customer/{CUSTOMER_TABLES[name]}")
    adapters.raw_survey(spark, SMALL).write.option("header", True).option("escape", '"').csv(f"{root}/survey")
    inputs = pipeline.Inputs(f"{root}/credit/*{snapshots.FILE_GLOB}", f"{root}/customer", f"{root}/survey")
    out = pipeline.Warehouse(str(tmp_path_factory.mktemp("warehouse")))
    pipeline.profile(spark, inputs, out)
    pipeline.stage(spark, inputs, out)
    pipeline.build_marts(spark, out)
    return inputs, out


def test_every_stage_leaves_its_tables(spark, built):
    _, out = built
    checks = pipeline.check(spark, out, F.lit(AS_OF)).collect()
    assert len(checks) == 6 and all(c.ts is not None for c in checks)
    pipeline.analyse(spark, out)
    for name in ("portfolio_metrics", "portfolio_by_segment", "divergent_segments", "nps_by_risk", "cleaned_summary",
                 "profile_credit", "profile_customer", "profile_nps", "dataset_summary", "cleaning_report", "snapshot_counts",
                 "portfolio_growth", "relationships", "vocabulary", "status_counts", "numeric_summary", "birth_years", "outliers",
                 "missing_columns", "gate"):
        assert spark.read.option("header", True).csv(out.path(name)).columns, name
    assert out.read(spark, "orphans").columns == ["source", "missing_in", "loan_id"]
    report = spark.read.option("header", True).csv(out.path("cleaning_report"))
    assert report.filter("metric LIKE 'date_warning::%' OR metric LIKE 'pct_with_%'").select("metric").distinct().count() >= 4
    again = pipeline.check(spark, out, F.lit(AS_OF))
    assert again.count() == 6 and out.read(spark, "dq_results").count() == 12


def test_a_second_run_changes_nothing(spark, built):
    inputs, out = built
    tables = ("stg_credit_snapshot", "stg_customer", "stg_nps", "dim_customer", "fct_credit_snapshot")
    before = {t: rows(out.read(spark, t)) for t in tables}
    pipeline.stage(spark, inputs, out)
    pipeline.build_marts(spark, out)
    for name in tables:
        assert rows(out.read(spark, name)) == before[name], name


def test_staged_rows_equal_the_cleaned_frame(spark, built):
    _, out = built
    direct = staging.clean_credit_snapshot(adapters.raw_credit(spark, SMALL))
    assert rows(out.read(spark, "stg_credit_snapshot").select(direct.columns)) == rows(direct)


def test_fact_has_one_row_per_staged_row(spark, built):
    _, out = built
    fct, stg = out.read(spark, "fct_credit_snapshot"), out.read(spark, "stg_credit_snapshot")
    assert fct.count() == stg.count()
    assert set(fct.columns) - set(stg.columns) == {"dob", "age_at_report", "age_band", "days_past_due_derived", "risk_category"}
