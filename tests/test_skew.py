"""A key with a third of all rows, on sizes small enough to test."""

import re

import pytest
from pyspark.sql import functions as F

from loanlens.operators import metrics


@pytest.fixture
def eager_skew(spark):
    """Thresholds so low that the test data counts as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_segment_join_splits_the_hot_loan(spark, eager_skew):
    fct = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("loan_id"),
        F.lit("2025-12-30").cast("date").alias("snapshot_date"),
        (F.col("id") % 5).alias("days_past_due"),
        F.lit("Existing Active").alias("account_status_l1"),
        F.lit("Low").alias("risk_category"),
        F.lit("18-25").alias("age_band"),
    )
    dim = spark.range(0, 60000).select(F.col("id").alias("loan_id"), F.when(F.col("id") == 7, "hot").otherwise("cold").alias("band"))
    result = metrics.segment_kpis(metrics.segment_base(fct, dim, income_band="band"), "income_band")
    assert {r.segment: r.n_loans for r in result.collect()} == {"hot": 20001, "cold": 39999}
    assert re.search(r"SortMergeJoin\(skew=true\)", result._jdf.queryExecution().executedPlan().toString())
