"""The query register and helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with comparison SQL where SQL can express it."""

    def register(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(run(configure(spark), sf_dir))

        QUERIES[name] = configured
        if sql:
            ORACLES[name] = sql
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and instants as text, so that results compare without time types."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums and rates rounded, so that the order of additions does not show."""
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
