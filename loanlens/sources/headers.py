"""Header clean-up.  Only names are touched, so none of this costs a pass over data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names that readers give to a column whose header is empty.
BLANK_HEADER = re.compile(r"^(_c\d+|Unnamed: \d+)$")


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def snake_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def pick_header(df: DataFrame, stem: str) -> str:
    """The first header that contains the stem, whatever its case."""
    for name in df.columns:
        if stem.lower() in name.lower():
            return name
    raise ValueError(f"no header contains {stem!r}")


def drop_blank_headers(df: DataFrame) -> DataFrame:
    """Drop columns without a header, provided they hold no value at all.

    One aggregate over the blank-header columns only; a column that turns out to hold
    data is kept, so nothing is lost unseen.
    """
    blank = [name for name in df.columns if BLANK_HEADER.match(name)]
    if not blank:
        return df
    filled = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in blank]).first()
    return df.drop(*[name for name in blank if filled[name] == 0])
