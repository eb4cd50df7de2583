"""Credit snapshot files: one CSV file, or one folder of CSV parts, per snapshot date."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.schemas import CREDIT_COLUMNS, CREDIT_KEY, CREDIT_STATUS
from loanlens.sources.first_lines import Part, first_lines, parse_header, parts, scan
from loanlens.sources.headers import drop_blank_headers

# Fixed value: file names carry the snapshot date as day-month-year.
FILE_PATTERN = r"Credit_Data_-_(\d{2})-(\d{2})-(\d{4})\.csv(?:/[^/]*)?$"
FILE_GLOB = "Credit_Data_-_*.csv"
EXPORT_NAME = re.compile(r"^(.*Credit_Data_-_(\d{2})-(\d{2})-(\d{4})\.csv)")

# Headers are known in any case and with blanks around.
KNOWN = {header.upper(): header for header, _, _ in CREDIT_COLUMNS}


def snapshot_date_of(path: Column) -> Column:
    """Snapshot date in a file path; a path without one stops the job.

    Every row asks, so what is plain is read by place; the pattern decides the rest.
    """
    name = F.substring_index(path, "Credit_Data_-_", -1)
    text = F.concat(F.substring(name, 7, 4), F.substring(name, 3, 4), F.left(name, F.lit(2)))
    file = F.substring_index(path, "/", -1)
    in_place = F.concat(F.left(name, F.lit(10)), F.lit(".csv/"), file) == name
    plain = text.try_cast("date")
    day, month, year = (F.regexp_extract(path, FILE_PATTERN, i) for i in (1, 2, 3))
    return F.when(in_place & (plain.cast("string") == text), plain).when(
        day != "", F.make_date(year.try_cast("int"), month.try_cast("int"), day.try_cast("int"))
    ).otherwise(F.raise_error(F.concat(F.lit("no snapshot date in file name: "), path)).cast("date"))


def snapshot_and_export(path: str) -> tuple[str, str]:
    """The snapshot date in a CSV file's path, and the file or folder that carries the name."""
    return date_of(Part(path, path, ())), EXPORT_NAME.match(path).group(1)


def _canonical(header: tuple[str, ...], path: str) -> tuple[str, ...]:
    names = tuple(KNOWN.get(name.strip().upper(), name.strip()) for name in header)
    seen = [name.upper() for name in names]
    twice = sorted({name for name in seen if seen.count(name) > 1})
    if twice:
        raise ValueError(f"{path} has the same column twice: {', '.join(twice)}")
    return names


def find_snapshots(spark: SparkSession, *patterns: str) -> list[Part]:
    """The exports behind globs or folders with their canonical headers."""
    def export(path: Column) -> Column:
        named = F.regexp_extract(path, EXPORT_NAME.pattern, 1)
        return F.when(named == "", path).otherwise(named)

    return [Part(p.group, p.path, _canonical(p.header, p.path)) for p in parts(spark, *patterns, group=export)]


def find_files(spark: SparkSession, *paths: str) -> list[Part]:
    """Single files with their canonical headers, each by itself."""
    heads = sorted((unquote(r.path), r.line) for r in first_lines(spark, *paths).collect())
    return [Part(path, path, _canonical(parse_header(line), path)) for path, line in heads]


def manifest(exports: list[Part]) -> dict[str, list[str]]:
    """Raw columns that each snapshot's files all have, by snapshot date."""
    held: dict[str, set[str]] = {}
    for part in exports:
        date = date_of(part) if EXPORT_NAME.match(part.group) else part.group
        held[date] = held.get(date, set(part.header)) & set(part.header)
    return {date: sorted(columns) for date, columns in sorted(held.items())}


def date_of(part: Part) -> str:
    """The snapshot date in an export's name."""
    named = EXPORT_NAME.match(part.group)
    if not named:
        raise ValueError(f"no snapshot date in file name: {part.group}")
    return str(dt.date(int(named[4]), int(named[3]), int(named[2])))


def read_each(spark: SparkSession, exports: list[Part]) -> dict[str, DataFrame]:
    """The raw text columns of every snapshot by itself, by date, each with ``snapshot_date``."""
    dated: dict[str, list[Part]] = {}
    for part in exports:
        dated.setdefault(date_of(part), []).append(part)
    return {date: read_snapshots(spark, parts) for date, parts in sorted(dated.items())}


def require_columns(exports: list[Part], *names: str) -> None:
    """Stop if a snapshot lacks a column without which its rows mean nothing."""
    lacking = [f"{part.path} ({name})" for part in exports for name in names if name not in part.header]
    if lacking:
        raise ValueError(f"snapshot without required column: {', '.join(lacking)}")


def read_snapshots(spark: SparkSession, exports: list[Part], drop_blank: bool = False) -> DataFrame:
    """Raw text columns of the exports, plus ``snapshot_date``.

    One scan per distinct header, joined up by name, so columns may come, go and change
    places between snapshots and between the parts of one.  ``drop_blank`` drops a column
    without header if it holds nothing, at the price of one more pass over its files; kept,
    it is a text column of nulls that costs next to nothing.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for part in exports:
        by_header.setdefault(part.header, []).append(part.path)
    frames = []
    for header, paths in by_header.items():
        dated = scan(spark, header, paths).withColumn("snapshot_date", snapshot_date_of(F.col("_metadata.file_path")))
        frames.append(drop_blank_headers(dated) if drop_blank else dated)
    return union_by_name(frames)


def read_snapshot_files(
    spark: SparkSession, *patterns: str, drop_blank: bool = False, required: tuple[str, ...] = (CREDIT_KEY, CREDIT_STATUS)
) -> DataFrame:
    """Raw text columns of all snapshot files behind globs or folders, plus ``snapshot_date``.

    No file at all is an error, and so is a snapshot without a ``required`` column.
    """
    exports = find_snapshots(spark, *patterns)
    if not exports:
        raise ValueError(f"no snapshot files match {', '.join(patterns)}")
    require_columns(exports, *required)
    return read_snapshots(spark, exports, drop_blank)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column some frame lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
