"""Which keys occur in which source: coverage, orphans, duplicates.

All answers come from one table, ``key_presence``: a union of bare keys counted per key
and source.  The counts are combined before the shuffle, so a key with a third of all
rows travels as one row per task, and no join between the sources is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.rates import percent, tally
from loanlens.operators.cleaning import col
from loanlens.sources.snapshots import union_by_name


def key_presence(**sources: tuple[DataFrame, str] | tuple[DataFrame, str, str]) -> DataFrame:
    """(key, n_<source>...): rows of each source per key, the null key included.

    A source is a frame and its key, and a third name if it is counted already.
    """
    bare = [
        df.select(
            col(key).cast("string").alias("key"),
            *[(F.lit(0) if other != name else col(n[0]) if n else F.lit(1)).cast("long").alias(f"n_{other}") for other in sources],
        )
        for name, (df, key, *n) in sources.items()
    ]
    return union_by_name(bare).groupBy("key").agg(*[F.sum(f"n_{name}").alias(f"n_{name}") for name in sources])


def orphan_keys(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks.

    Both sides are made distinct first; the anti join then reuses that partitioning.
    """
    known = other.select(col(other_key).alias(key)).distinct()
    return df.select(col(key)).dropna().distinct().join(known, key, "left_anti")


def has(name: str):
    return F.col("key").isNotNull() & (F.col(f"n_{name}") > 0)


def coverage(presence: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Per pair: distinct keys of the first source, those also in the second, percent."""
    counts = presence.agg(
        *[tally(has(a)).alias(f"{a}>{b}:all") for a, b in pairs],
        *[tally(has(a) & has(b)).alias(f"{a}>{b}:both") for a, b in pairs],
    )
    rows = [
        F.struct(
            F.lit(a).alias("source"),
            F.lit(b).alias("target"),
            col(f"{a}>{b}:all").alias("n_keys"),
            col(f"{a}>{b}:both").alias("n_covered"),
        )
        for a, b in pairs
    ]
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumn("coverage_pct", percent(F.col("n_covered"), F.col("n_keys")))
    )


def orphan_counts(presence: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row: ``<a>_not_in_<b>`` per pair."""
    return presence.agg(*[tally(has(a) & ~has(b)).alias(f"{a}_not_in_{b}") for a, b in pairs])


def relationship_metrics(
    presence: DataFrame, unresolved: list[str], pairs: list[tuple[str, str]], duplicates: list[str], sources: list[str]
) -> DataFrame:
    """Long (metric, value) table: distinct keys, unresolved keys, coverage, duplicates.

    A duplicate is any row beyond the first of its key; null keys count as one key.
    """
    n = {name: F.col(f"n_{name}") for name in sources}
    metrics = {f"{name}_unique_keys": tally(has(name)).cast("double") for name in sources}
    for name in unresolved:
        metrics[f"{name}_unresolved_keys"] = F.sum(F.when(F.col("key") == "#N/A", n[name]).otherwise(0)).cast("double")
    for a, b in pairs:
        metrics[f"{a}_in_{b}_pct"] = percent(tally(has(a) & has(b)), tally(has(a)))
    for name in duplicates:
        metrics[f"{name}_duplicate_keys"] = F.sum(F.when(n[name] > 1, n[name] - 1).otherwise(0)).cast("double")
    counts = presence.agg(*[value.alias(metric) for metric, value in metrics.items()])
    return counts.unpivot([], list(metrics), "metric", "value")
