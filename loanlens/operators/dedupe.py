"""One row per key.

A row number with ``= 1`` lets Spark keep the best row per key inside every map task
before the shuffle, so a key that owns a large share of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.functions.values import instant
from loanlens.operators.cleaning import col
from loanlens.schemas import OTHER_PROVIDER_RANK, PROVIDER_RANK


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row per key in the given order.

    All columns follow as tie-break (smallest first, nulls last), so the choice depends
    on the data only and never on file order or partitioning.
    """
    ties = [col(name).asc_nulls_last() for name in df.columns if name not in keys]
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order, *(ties or [F.lit(0)]))
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def provider_rank(provider: Column) -> Column:
    rank = F.lit(OTHER_PROVIDER_RANK)
    for name, value in PROVIDER_RANK.items():
        rank = F.when(provider == name, value).otherwise(rank)
    return rank


def resolve_by_provider(df: DataFrame, key: str, provider: str, created: str) -> DataFrame:
    """Most trusted provider per key, then its newest record."""
    order = [provider_rank(col(provider)).asc(), col(created).desc_nulls_last()]
    return first_per_key(df, [key], order)


def longest_history(df: DataFrame, key: str, duration: str, received: str) -> DataFrame:
    """Row with the longest duration per key, then the largest total."""
    return first_per_key(df, [key], [col(duration).desc_nulls_last(), col(received).desc_nulls_last()])


def latest_state(df: DataFrame, key: str = "loan_id", at: str = "snapshot_date") -> DataFrame:
    """Newest snapshot row per loan."""
    return first_per_key(df, [key], [col(at).desc_nulls_last()])


def parse_dob_table(dob: DataFrame) -> DataFrame:
    """Instants for the two text columns of the date-of-birth table."""
    return dob.withColumn("dob", instant(F.col("date_of_birth"))).withColumn(
        "created_at", instant(col("createdAt UTC"))
    )
