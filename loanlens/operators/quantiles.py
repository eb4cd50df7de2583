"""Exact quantiles and moments of counted values.

Columns are first counted by value, combined before the shuffle, so that what follows is
about different values and a value that fills a column is one row.  The counts are dealt by
ranges of (name, value) and written once, in blocks of a bounded number of rows.  A prefix sum
over the blocks' totals tells which block holds a wanted rank, and a prefix sum inside that block
which value: no sort sees more than one range, no window over values more than one block, and the
source is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import materialised

# The id of a row of a sorted range is the range's number and its place; without so many low bits
# of the place it is the number of a block.
BLOCK_BITS = 18


def counted(rows: DataFrame) -> DataFrame:
    """(name, value, n) of ``rows`` (name, value); null is a value, and -0.0 is 0.0."""
    return rows.groupBy("name", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def sorted_blocks(counts: DataFrame) -> DataFrame:
    """(name, value, n, at, block) of ``counts``: ``at`` and ``block`` rise with a name's values.

    The sort of a range is by value alone, which orders each name's rows and is compared as a number.
    """
    placed = counts.repartitionByRange("name", "value").sortWithinPartitions("value").withColumn("at", F.monotonically_increasing_id())
    return materialised(placed, "quantile-ranges").withColumn("block", F.shiftright("at", BLOCK_BITS))


def quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(name, prob, value): quantiles of ``counts`` (name, value, n) with linear interpolation.

    Nulls and NaN are left out; a name without values is absent from the result.
    """
    clean = counts.filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("n") > 0)).select("name", "value", "n")
    blocks = sorted_blocks(clean)
    # One row per name and block, a quarter of a million times fewer than values.
    whole = Window.partitionBy("name")
    totals = blocks.groupBy("name", "block").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(whole.orderBy("block")) - F.col("held")
    place = F.col("prob") * (F.col("total") - 1)
    wanted = (
        totals.withColumns({"before": before, "total": F.sum("held").over(whole)})
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("end", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("rank", F.when(F.col("end") == 0, F.floor(place)).otherwise(F.ceil(place)))
        .withColumn("share", place - F.floor(place))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held")))
        .select("name", "block", "before", "prob", "end", "rank", "share")
    )
    # Twice as many rows as names and probabilities, so always small enough to broadcast.
    inside = blocks.join(F.broadcast(wanted.select("name", "block", "before").distinct()), ["name", "block"])
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("name", "block").orderBy("at"))
    sums = inside.select("name", "block", "value", (upto - F.col("n")).alias("from"), upto.alias("upto"))
    hits = sums.join(F.broadcast(wanted.drop("before")), ["name", "block"]).filter("rank >= from AND rank < upto")
    ends = hits.groupBy("name", "prob").agg(
        F.max(F.when(F.col("end") == 0, F.col("value"))).alias("low"),
        F.max(F.when(F.col("end") == 1, F.col("value"))).alias("high"),
        F.max("share").alias("share"),
    )
    return ends.select("name", "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("value"))


def exact_quantiles(rows: DataFrame, probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of ``rows`` (name, value) per name: as many numbers as names and probabilities."""
    found = {(r.name, r.prob): r.value for r in quantiles(counted(rows), probs).collect()}
    return {name: [found[name, float(p)] for p in probs] for name, _ in found}


def summary(counts: DataFrame) -> DataFrame:
    """(name, count, mean, std, min, p25, p50, p75, max) of ``counts`` (name, value, n); the quartiles are exact."""
    n, value = F.col("n"), F.col("value")
    filled = F.when(value.isNotNull(), n)
    moments = counts.groupBy("name").agg(
        F.coalesce(F.sum(filled), F.lit(0)).alias("count"), (F.sum(value * n) / F.sum(filled)).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    # The mean first: squares about it do not cancel.  One row per name.
    apart = counts.join(F.broadcast(moments.select("name", "mean")), "name")
    squares = apart.groupBy("name").agg(F.sum(n * (value - F.col("mean")) * (value - F.col("mean"))).alias("squares"))
    quarters = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    cuts = quantiles(counts, list(quarters)).groupBy("name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(c) for p, c in quarters.items()]
    )
    std = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return moments.join(squares, "name").join(cuts, "name", "left").select(
        "name", "count", "mean", std.alias("std"), "min", "p25", "p50", "p75", "max"
    )
