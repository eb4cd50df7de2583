"""Column and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.rates import percent, tally
from loanlens.functions.values import full_days, null_if_token
from loanlens.operators.cleaning import col
from loanlens.operators.quality import SCORE_FROM, SCORE_TO
from loanlens.operators.quantiles import counted, summary
from loanlens.session import materialised
from loanlens.sources.snapshots import union_by_name


def _as_text(field: T.StructField) -> Column:
    """Text form under which equal values are equal; adding 0 turns -0.0 into 0.0."""
    value = col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return value.cast("string")


def text_kind(value: Column) -> Column:
    """What a text value looks like, as a bit: 0 nothing, 1 a whole number, 2 a number, 4 a date, 8 text.

    Numbers and dates begin with white space, a sign, a point or a digit, all of which sort below
    the colon, so most texts need no pattern.  A whole number is one without point or exponent.
    """
    number = value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    part = value.contains(".") | value.contains("e") | value.contains("E")
    date = value.rlike(r"^\s*(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{1,2}-\d{1,2}([T ].*)?)\s*$")
    known = F.when(value.isNull(), 0).when(value >= ":", 8).when(number, F.when(part, 2).otherwise(1))
    return known.when(date, 4).otherwise(8)


def column_values(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n): how often each value occurs in each column.

    All columns in one pass; counts are combined before the shuffle, so a value that
    fills most of a column costs one row per task.  Columns are counted by their number, as a
    name would be hashed and shuffled with every value.
    """
    names = [c for c in (columns or df.columns) if c not in by]
    fields = [f for f in df.schema.fields if f.name in names]
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), _as_text(f).alias("value")) for i, f in enumerate(fields)])
    long = df.select(*[col(b) for b in by], F.inline(pairs))
    counts = long.groupBy(*[col(b) for b in by], "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("column", F.get(F.array(*[F.lit(f.name) for f in fields]), F.col("column")))


def raw_profile(df: DataFrame, source: str | None = None, by: str | None = None, held: DataFrame | None = None) -> DataFrame:
    """The profile of raw text, see ``profile_of_values``."""
    return profile_of_values(column_values(df, by=[by] if by else []), source, by, held)


def profile_of_values(values: DataFrame, source: str | None = None, by: str | None = None, held: DataFrame | None = None) -> DataFrame:
    """Profile of counted raw texts (by, column, value, n): null tokens are nulls, and the values tell the type.

    A column is ``whole`` if all its values are, ``fraction`` if all are numbers, ``date`` if
    all look like dates, ``empty`` without values, and ``string`` otherwise; how many rows look
    like which is counted too, as a column of mixed kinds is a drift worth seeing.  ``held``
    lists (by, column) that the files have; without it all columns count as held everywhere.
    """
    keys = [by] if by else []
    values = values.withColumn("value", null_if_token(F.col("value"))).withColumn("kind", text_kind(F.col("value")))
    # Numbers and dates in one column are text, so the kinds of all values are kept.
    kinds = {"n_whole": 1, "n_fraction": 2, "n_date": 4, "n_text": 8}
    stats = values.groupBy(*keys, "column").agg(
        F.bit_or("kind").alias("kinds"),
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_unique"),
        F.min("value").alias("sample"),
        *[F.sum(F.when(F.col("kind") == bit, F.col("n")).otherwise(0)).alias(name) for name, bit in kinds.items()],
    )
    if held is not None:
        stats = stats.join(held, [*keys, "column"], "left_semi")
    seen = F.col("kinds")
    dtype = (
        F.when(seen == 0, "empty").when(seen == 1, "whole").when(seen.isin(2, 3), "fraction")
        .when(seen == 4, "date").otherwise("string")
    )
    named = F.concat_ws("::", *([F.lit(source)] if source else []), *[col(k).cast("string") for k in keys])
    return stats.select(
        named.alias("source"), "column", dtype.alias("dtype"), "rows", "n_null",
        percent(F.col("n_null"), F.col("rows")).alias("pct_null"), "n_unique", "sample", *kinds,
    )


def column_profile(df: DataFrame, source: str | None = None, by: str | None = None, exact: bool = True) -> DataFrame:
    """Per column: type, rows, nulls, distinct values and the smallest value as sample.

    ``by`` profiles per value of a column (its text follows ``source`` in the name).
    Exact distinct counts shuffle every distinct value once; ``exact=False`` estimates
    them in a single pass that shuffles sketches only.
    """
    keys = [by] if by else []
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in keys}
    if exact:
        stats = column_values(df, by=keys).groupBy(*keys, "column").agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
            F.count("value").alias("n_unique"),
            F.min("value").alias("sample"),
        )
    else:
        stats = _sketched(df, keys, list(types))
    dtype = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])[F.col("column")]
    named = F.concat_ws("::", *([F.lit(source)] if source else []), *[col(k).cast("string") for k in keys])
    return stats.select(
        named.alias("source"),
        "column",
        dtype.alias("dtype"),
        "rows",
        "n_null",
        percent(F.col("n_null"), F.col("rows")).alias("pct_null"),
        "n_unique",
        "sample",
    )


def _sketched(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    fields = {f.name: f for f in df.schema.fields}
    wide = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.struct(
                F.count(col(c)).alias("filled"),
                F.approx_count_distinct(col(c)).alias("n_unique"),
                F.min(_as_text(fields[c])).alias("sample"),
            ).alias(c)
            for c in names
        ],
    )
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"`{c}`.filled")).alias("n_null"),
            F.col(f"`{c}`.n_unique").alias("n_unique"),
            F.col(f"`{c}`.sample").alias("sample"),
        )
        for c in names
    ])
    return wide.select(*keys, F.inline(rows))


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each enum column with their counts, nulls left out."""
    return vocabulary_of_values(column_values(df, columns), columns)


def vocabulary_of_values(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same of counted values (column, value, n), whatever else they are counted by."""
    chosen = values.filter(F.col("column").isin(list(columns)) & F.col("value").isNotNull())
    return chosen.groupBy("column", "value").agg(F.sum("n").alias("n")).orderBy("column", "value")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value as it stands, null included, most frequent first."""
    return counts_of_values(column_values(df, [column]), [column]).drop("column")


def counts_of_values(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of the columns, each most frequent first, from counted values."""
    chosen = values.filter(F.col("column").isin(list(columns)))
    return (
        chosen.groupBy("column", "value").agg(F.sum("n").alias("n"))
        .orderBy("column", F.col("n").desc(), F.col("value").asc_nulls_last())
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column; the quartiles are exact.

    The columns are counted by value once, by their number as in ``column_values``; everything is
    taken from the written counts.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("name"), col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    counts = materialised(counted(df.select(F.inline(pairs))), "value-counts")
    named = F.get(F.array(*[F.lit(c) for c in columns]), F.col("name"))
    return summary(counts).withColumn("name", named).withColumnRenamed("name", "column")


def year_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows of every year, its place from either end, and the range of years.

    Null counts as the last year and is not in the range.  The windows see one row per
    year only.
    """
    years = df.groupBy(F.year(col(column)).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    return years.select(
        "year", "n",
        F.row_number().over(Window.orderBy(F.col("year").asc_nulls_last())).alias("from_first"),
        F.row_number().over(Window.orderBy(F.col("year").desc_nulls_first())).alias("from_last"),
        F.min("year").over(whole).alias("first_year"),
        F.max("year").over(whole).alias("last_year"),
    )


def outlier_counts(dob: DataFrame, income: DataFrame, survey: DataFrame, as_of: Column) -> DataFrame:
    """Implausible raw values and the implied ages' range.  Here 100 years is out of range, unlike in the range check."""
    age = full_days(F.col("dob"), as_of) / F.lit(365.25)
    score = F.col("nps_score")
    ages = dob.agg(
        tally(age < 18).cast("double").alias("age_below_18"),
        tally(age >= 100).cast("double").alias("age_100_or_more"),
        F.round(F.min(age), 1).alias("age_min"),
        F.round(F.max(age), 1).alias("age_max"),
    )
    incomes = income.agg(
        tally(F.col("received_total") <= 0).cast("double").alias("income_not_positive"),
        F.count_distinct("duration_months").cast("double").alias("distinct_durations"),
    )
    scores = survey.agg(tally((score < SCORE_FROM) | (score > SCORE_TO)).cast("double").alias("score_out_of_range"))
    return union_by_name([part.unpivot([], part.columns, "metric", "value") for part in (ages, incomes, scores)])


def dataset_summary(**frames: DataFrame) -> DataFrame:
    return union_by_name([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("bigint").alias("cols")
        )
        for name, df in frames.items()
    ])
