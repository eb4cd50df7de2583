"""Row and column clean-up with a full account of what was dropped."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.rates import tally
from loanlens.functions.values import null_if_token, same_word, stripped, us_date
from loanlens.schemas import UNRESOLVED_KEY


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def col(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col(f"`{name}`")


def _rewrite(df: DataFrame, names: Iterable[str], rule) -> DataFrame:
    chosen = set(names)
    return df.select(*[rule(col(n)).alias(n) if n in chosen else col(n) for n in df.columns])


def trim_strings(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    return _rewrite(df, names or text_columns(df), stripped)


def normalise_nulls(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Null for every text that stands for a missing value; run it before trimming."""
    return _rewrite(df, text_columns(df), lambda c: null_if_token(c, tokens))


def parse_us_dates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return _rewrite(df, names, us_date)


def lower_values(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return _rewrite(df, names, F.lower)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Without rows in which every column is null (sheet padding)."""
    return df.dropna(how="all")


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def is_test_row(status: Column) -> Column:
    return same_word(status, "demo")


def drop_test_rows(df: DataFrame, status: str = "account_status_l1") -> DataFrame:
    return df.filter(~is_test_row(col(status)))


def key_fault(key: Column) -> Column:
    """Why a key cannot be joined on; null for a usable key."""
    return F.when(key.isNull(), "null_key").when(key.cast("string") == UNRESOLVED_KEY, "unresolved_key")


def split_by_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable key, and the other rows with the reason."""
    tagged = df.withColumn("reason", key_fault(col(key)))
    return tagged.filter("reason IS NULL").drop("reason"), tagged.filter("reason IS NOT NULL")


def date_agreement(df: DataFrame, partition: str = "snapshot_date", reported: str = "reporting_date") -> DataFrame:
    """Per snapshot: does the data carry exactly one reporting date, the snapshot's own?

    Count, lowest and highest date say all that is needed, so no set of dates is built.
    """
    n_dates = F.col("n_dates")
    return (
        df.groupBy(partition)
        .agg(
            F.count_distinct(reported).alias("n_dates"),
            F.min(reported).alias("first_date"),
            F.max(reported).alias("last_date"),
        )
        .withColumn(
            "verdict",
            F.when(n_dates == 0, "no date")
            .when(n_dates > 1, "several dates")
            .when(F.col("first_date") != F.col(partition), "other date")
            .otherwise("agrees"),
        )
    )


def drop_report(tagged: DataFrame, source: str | None, key: str, reasons: list[str]) -> DataFrame:
    """Long report (source, metric, value) of tagged rows: every input row is counted once.

    ``tagged`` has a ``drop_reason`` column, null on the rows that stay; ``source`` names
    the column to report by, or nothing for one report.
    """
    kept = F.col("drop_reason").isNull()
    counts = tagged.groupBy(*([source] if source else [])).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[tally(F.col("drop_reason") == reason).alias(f"dropped_{reason}") for reason in reasons],
        tally(kept).alias("rows_out"),
        F.count_distinct(F.when(kept, col(key))).alias("unique_keys"),
    )
    metrics = ["rows_in", *[f"dropped_{reason}" for reason in reasons], "rows_out", "unique_keys"]
    return counts.unpivot([source] if source else [], metrics, "metric", "value")
