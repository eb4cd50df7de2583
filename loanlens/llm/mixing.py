"""Mixing of sources to target weights by thresholds on a hash.

Every document has a hash point.  A source's budget is met by the documents below a
threshold on that point, so a smaller budget always takes a subset of what a larger one
takes.  The threshold is found from sums of tokens by source and bucket of points: the
bucket in which the budget runs out is cut into finer buckets, and only that one, until
its rest is a cell of a 2**-36th part of all points.  No sort of documents, no rank.

Sources whose target exceeds their size are taken once whole, and the threshold then
chooses what is taken a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm.text import n_words, point
from loanlens.session import materialised

LEVELS = 3
BITS = 12
HEX_DIGITS = LEVELS * BITS // 4


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target of each source from (source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn, repeating.  They
    share ``share`` times all sizes by weight; none gets more than ``most`` times its own
    size, and what it leaves goes to the others by weight.  In the order in which sources
    reach their limit, the first that stays below it sets the level for all that follow.
    """
    if share > most:
        raise ValueError("the sources cannot hold that much")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    limit = F.col("source_size") * F.lit(float(most))
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("_weight", weight).withColumn("_limit", limit)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))
    rows = rows.withColumn("_level", left / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))))
    free = F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.col("_level"))
    rows = rows.withColumn("_free", F.first(free, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("_free").isNull(), F.col("_limit")).otherwise(F.col("_free") * F.col("_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _cell(level: int) -> Column:
    return F.shiftright("point", BITS * (LEVELS - level)).cast("long")


def thresholds(narrow: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, below): take ``whole`` copies of every document and
    one more of those whose point is smaller than ``below``.

    ``narrow`` holds (source, size, point).  Each level reads one sum per source and cell;
    the tables between the levels have one row per source and are written, so that Spark
    knows their size before it decides whether to broadcast them.
    """
    whole = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    edge = goals.select(
        "source", "source_size", "target", whole.cast("long").alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("left"), F.lit(0).cast("long").alias("cell"),
    )
    edge = materialised(edge, "mix-goals")
    in_source = Window.partitionBy("source").orderBy("next")
    for level in range(1, LEVELS + 1):
        e = edge.alias("e")
        n = narrow.alias("n")
        here = F.col("n.source").eqNullSafe(F.col("e.source")) & (_cell(level - 1) == F.col("e.cell"))
        cells = n.join(e, here).groupBy(F.col("n.source").alias("source"), _cell(level).alias("next")).agg(F.sum("n.size").alias("sum"))
        cells = cells.withColumn("upto", F.sum("sum").over(in_source))
        e2 = edge.alias("e")
        placed = e2.join(cells.alias("c"), F.col("c.source").eqNullSafe(F.col("e.source")), "left")
        over = F.col("upto") > F.col("left")
        kept = [F.col(f"e.{c}").alias(c) for c in ("source", "source_size", "target", "whole", "left", "cell")]
        found = placed.select(*kept, F.struct("next", "sum", "upto").alias("c"), over.alias("over"))
        # The first cell that the budget does not cover; if it covers all, the end of the outer cell.
        edge = found.groupBy("source", "source_size", "target", "whole", "left", "cell").agg(
            F.min(F.when(F.col("over"), F.col("c"))).alias("c"), F.max("c.upto").alias("all")
        )
        past = (F.col("cell") + 1) * (1 << BITS)
        edge = edge.select(
            "source", "source_size", "target", "whole",
            F.when(F.col("c").isNull(), F.col("left") - F.coalesce("all", F.lit(0)))
            .otherwise(F.col("left") - F.col("c.upto") + F.col("c.sum")).alias("left"),
            F.coalesce("c.next", past).alias("cell"),
            F.coalesce("c.sum", F.lit(0)).cast("long").alias("last"),
        )
        edge = materialised(edge, f"mix-level-{level}")
    # The last cell goes with the side that is nearer to the target.
    taken = (F.col("last") > 0) & (F.col("last") - F.col("left") <= F.col("left"))
    below = F.col("cell") + F.when(taken, 1).otherwise(0)
    return edge.select("source", "source_size", "target", "whole", below.alias("below"))


def plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """The narrow table (doc_id, source, size, point) of all documents, and the thresholds by source."""
    if most > 2:
        raise ValueError("a document is taken twice at most")
    narrow = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), point(F.col("doc_id"), HEX_DIGITS).alias("point")
    )
    narrow = materialised(narrow, "mix-points")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    return narrow, thresholds(narrow, targets(sizes, weights, share, most))


def _copies(rows: DataFrame, limits: DataFrame) -> DataFrame:
    r, t = rows.alias("r"), limits.alias("t")
    joined = r.join(t, F.col("r.source").eqNullSafe(F.col("t.source")))
    copies = F.col("t.whole") + F.when(F.col("r.point") < F.col("t.below"), 1).otherwise(0)
    return joined.select("r.*", "t.source_size", "t.target", copies.alias("_copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (both of its source), taken.

    ``taken`` is 0, 1 or 2 times the size.  Null text counts no words; null sources are one
    source; documents without an id share one point, and equal ids share theirs, so
    repeated rows are taken alike.  Empty documents and sources take nothing.  An empty
    table gives an empty result.
    """
    narrow, limits = plan(docs, **how)
    return _copies(narrow, limits).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, all columns: a document taken twice comes as two rows."""
    _, limits = plan(docs, **how)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", point(F.col("doc_id"), HEX_DIGITS).alias("point"))
    taken = _copies(inner, limits).filter("_copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("row.*")
