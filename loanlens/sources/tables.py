"""Customer tables, survey table, staged Parquet tables and the result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.schemas import CUSTOMER_TABLES
from loanlens.sources.first_lines import parts, scan
from loanlens.sources.headers import strip_headers
from loanlens.sources.snapshots import union_by_name


def read_text_table(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame:
    """A CSV table as text columns; its parts may order their columns differently.

    Free text may hold line breaks, which makes a file readable by one task only; ask
    for it where the source is known to have such text.  There the parts must agree on
    their header, and the scan stops on a difference.
    """
    if free_text:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
        return strip_headers(reader.schema(reader.csv(path).schema).option("enforceSchema", False).csv(path))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for part in parts(spark, path, group=lambda file: F.lit(path)):
        by_header.setdefault(tuple(name.strip() for name in part.header), []).append(part.path)
    if not by_header:
        raise ValueError(f"no table files in {path}")
    return union_by_name([scan(spark, header, paths) for header, paths in by_header.items()])


def read_customer_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four customer tables, one folder each below ``root``."""
    return {key: read_text_table(spark, f"{root}/{folder}") for key, folder in CUSTOMER_TABLES.items()}


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, free_text=True)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a flat Parquet table."""
    df.write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, by: str = "snapshot_date", *within: str, rebalance: bool = True) -> None:
    """Replace just the partitions present in ``df``; a rerun gives the same table.

    Rebalancing gathers each partition's rows into files of the advisory size and
    splits a partition that holds far more rows than the others.  Input that is already
    laid out by partition can skip that shuffle.
    """
    laid_out = df.hint("rebalance", by) if rebalance else df
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, *within).parquet(path)


def write_result(df: DataFrame, path: str) -> None:
    """A small report as a single CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to a log table without reading what is there."""
    df.write.mode("append").parquet(path)


def register_views(spark: SparkSession, **paths: str) -> None:
    """Expose Parquet tables (partitioned or flat) to SQL under the given names."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
