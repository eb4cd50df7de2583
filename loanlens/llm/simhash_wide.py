"""Near copies at a five-word similarity of 0.8 or more, by wide SimHash fingerprints.

Two texts of Jaccard similarity J have SimHash bits that differ with probability
acos(2J / (1 + J)) / pi, 15 % at 0.8: too many for one narrow fingerprint.  Here a fingerprint
has 512 bits, of each different shingle once.  Blocks of its bits are keys: so many bits each
that a block brings a document about one unrelated one, and so many blocks that all but
``MISSED`` of the pairs at 0.8 agree on one or more.  Documents join on blocks, then:

* pairs further apart than ``FAR`` bits are dropped, and pairs within ``NEAR`` link;
* between those, the texts' shingles are compared, unless other links join the two already.

Documents with equal fingerprints are one node from the start.  In a block's bucket each node
meets all others, unless the bucket has more than ``BUCKET`` and one of them.  That is far more
than chance brings together and takes a group of near copies; there each node meets the next
``CHAIN`` first, which joins the group as a chain, in every block anew, without naming its
pairs.  What such a bucket holds of groups that are still apart meets by rare shingles: similar
texts must share one of their rarest, by an exact bound on places and sizes (``_alike``).  So no
similar pair that shares a block goes unseen, and neither pairs of one group nor pairs that only
share what the whole bucket says are named.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.components import components
from loanlens.llm.simhash_dedup import shingle_hashes
from loanlens.llm.text import unused
from loanlens.session import materialised

SHINGLE = 5
SIMILARITY = 0.8
LANES = 8
BITS = 64 * LANES
# Share of the pairs at the least similarity that may share no block.
MISSED = 0.06
BUCKET = 16
CHAIN = 2
# Shingles whose bits are counted at a time; their counts fit 16 bits.
CHUNK = 1 << 15


def flips(similarity: float) -> float:
    """Probability that a bit differs between two sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def _deviations(similarity: float, n: float) -> int:
    p = flips(similarity)
    return round(BITS * p + n * math.sqrt(BITS * p * (1 - p)))


# Four deviations and more on either side of the least similarity's distance.
NEAR, FAR = _deviations(SIMILARITY, -4.5), _deviations(SIMILARITY, 4)

WIDE = T.StructType([T.StructField(f"w{i}", T.LongType()) for i in range(LANES)])


def fingerprint(text: bytes) -> np.ndarray:
    """The wide fingerprint as 64-bit words: a bit is 1 if it is set in over half of the different shingles' hashes."""
    hashes = np.unique(shingle_hashes(text, SHINGLE))
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK]
        lanes = np.empty((len(part), LANES), dtype=np.uint64)
        for i in range(LANES):
            # Each lane mixes the hash anew, by the multiplications of splitmix64.
            x = part + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            lanes[:, i] = x ^ x >> np.uint64(31)
        ones += np.unpackbits(lanes.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(hashes)).view(np.int64)


@F.pandas_udf(WIDE)
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame(np.array([fingerprint(t) for t in batch]).reshape(-1, LANES), columns=[f"w{i}" for i in range(LANES)])


def blocks_for(rows: int) -> tuple[int, int]:
    """(bits, blocks) for so many documents."""
    bits = min(max(12, math.ceil(math.log2(max(rows, 2)))), 40)
    return bits, math.ceil(math.log(MISSED) / math.log(1 - (1 - flips(SIMILARITY)) ** bits))


@cache
def _choices(bits: int, blocks: int) -> np.ndarray:
    """The bits of every block; a block takes no bit twice."""
    random = np.random.default_rng(42)
    return np.stack([random.choice(BITS, bits, replace=False) for _ in range(blocks)])


def _keys(bits: int, blocks: int) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(fp: pd.DataFrame) -> pd.Series:
        set_bits = np.unpackbits(np.ascontiguousarray(fp.to_numpy(dtype=np.int64)).view(np.uint8).reshape(len(fp), -1), axis=1)
        values = set_bits[:, _choices(bits, blocks)].astype(np.int64) @ (1 << np.arange(bits))
        return pd.Series(list(values))

    return keys


def jaccard(a: bytes, b: bytes) -> float:
    """Similarity of the sets of five-word shingles; 0 if neither has any."""
    x, y = np.unique(shingle_hashes(a, SHINGLE)), np.unique(shingle_hashes(b, SHINGLE))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(len(x) + len(y) - both, 1)


@F.pandas_udf(T.DoubleType())
def _similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([jaccard(x, y) for x, y in zip(a, b)], dtype="float64")


def _join(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A join of sorted sides, which can spill.

    Every table of this module grows with the documents, and its size in Spark's eyes tells little: an
    exploded array counts as one entry and a list of keys as one key, so millions of rows pass for the few
    MB below which Spark broadcasts, through the driver.
    """
    return left.join(right.hint("merge"), on, how)


def _apart(x: str, y: str) -> Column:
    """Bits in which two fingerprints differ."""
    lanes = [F.bit_count(F.col(f"{x}.w{i}").bitwiseXOR(F.col(f"{y}.w{i}"))) for i in range(LANES)]
    return sum(lanes[1:], lanes[0])


def _keyed(nodes: DataFrame, rows: int) -> DataFrame:
    """(id, block, key) of all nodes."""
    bits, blocks = blocks_for(rows)
    return nodes.select("id", F.posexplode(_keys(bits, blocks)("fp")).alias("block", "key"))


def _measured(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, bits) of the pairs that are at most ``FAR`` bits apart."""
    x, y = nodes.select(F.col("id").alias("a"), F.col("fp").alias("x")), nodes.select(F.col("id").alias("b"), F.col("fp").alias("y"))
    return _join(_join(met, x, "a"), y, "b").select("a", "b", _apart("x", "y").alias("bits")).filter(F.col("bits") <= FAR)


def _close(nodes: DataFrame, rows: int, bucket: int) -> DataFrame:
    """(a, b, bits) of nodes that share a block; of a large bucket, its chain."""
    same = Window.partitionBy("block", "key")
    following = same.orderBy("id").rowsBetween(1, bucket)
    met = _keyed(nodes, rows).withColumns({"n": F.count(F.lit(1)).over(same), "next": F.collect_list("id").over(following)})
    met = met.withColumn("next", F.when(F.col("n") > bucket + 1, F.slice("next", 1, CHAIN)).otherwise(F.col("next")))
    return _measured(met.select(F.col("id").alias("a"), F.explode("next").alias("b")).distinct(), nodes)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingles(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([np.unique(shingle_hashes(t, SHINGLE)).view(np.int64) for t in batch])


def _alike(texts: DataFrame) -> DataFrame:
    """(a, b) of ``texts`` (id, root, said): all pairs of different groups that can have the least similarity.

    Two sets of m and n that are so similar share k = (m + n) S / (1 + S) or more.  In one order
    of all shingles, the rarest first, the first that they share has k - 1 behind it in both; so
    it is early in both, and what most texts hold brings nobody together.
    """
    sets = texts.select("id", "root", _shingles("said").alias("all")).withColumn("size", F.size("all"))
    same = Window.partitionBy("shingle")
    held = sets.select("id", "root", "size", F.explode("all").alias("shingle"))
    # A shingle of a single group keeps its place, but meets nobody.
    known = held.withColumns({"n": F.count(F.lit(1)).over(same), "least": F.min("root").over(same), "most": F.max("root").over(same)})
    place = F.row_number().over(Window.partitionBy("id").orderBy("n", "shingle"))
    behind = F.col("size") - place
    early = known.withColumn("behind", behind).filter(F.col("behind") + 1 >= SIMILARITY * F.col("size") - 0.5)
    early = early.filter("least < most").select("id", "root", "size", "shingle", "behind")
    early = materialised(early, "wide-early")
    x = early.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("id", "root", "size", "behind")])
    y = early.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("id", "root", "size", "behind")])
    shared = F.least("behind_a", "behind_b") + 1 >= (F.col("size_a") + F.col("size_b")) * (SIMILARITY / (1 + SIMILARITY)) - 0.5
    met = _join(x, y, (x.shingle == y.shingle) & (F.col("root_a") < F.col("root_b")) & shared)
    return met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _across(nodes: DataFrame, rows: int, bucket: int, rooted: DataFrame, said: DataFrame) -> DataFrame:
    """(a, b, bits) of the nodes that share a large bucket, belong to different groups of ``rooted`` (id, root) and can be similar."""
    keyed = _keyed(nodes, rows)
    large = keyed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket + 1).select("block", "key")
    members = materialised(_join(_join(keyed, large, ["block", "key"]), rooted, "id"), "wide-large")
    # Buckets of a single group are done.
    mixed = members.groupBy("block", "key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    chosen = _join(members, mixed.select("block", "key"), ["block", "key"], "left_semi").select("id", "root").distinct()
    met = _measured(_alike(_join(chosen, said, "id")), nodes)
    # Of those, the pairs that share a block.
    bits, blocks = blocks_for(rows)
    keys = nodes.select("id", F.transform(_keys(bits, blocks)("fp"), lambda key, i: F.shiftleft(i.cast("long"), bits) + key).alias("keys"))
    of, to = keys.withColumnsRenamed({"id": "a", "keys": "of_a"}), keys.withColumnsRenamed({"id": "b", "keys": "of_b"})
    near = _join(_join(met, of, "a"), to, "b")
    return near.filter(F.arrays_overlap("of_a", "of_b")).select("a", "b", "bits")


def _joined(rooted: DataFrame, close: DataFrame, said: DataFrame) -> DataFrame:
    """(id, root) after the pairs ``close`` (a, b, bits) have joined the groups of ``rooted``: by distance, then by text."""
    of = rooted.select(F.col("id").alias("a"), F.col("root").alias("of_a"))
    to = rooted.select(F.col("id").alias("b"), F.col("root").alias("of_b"))
    between = _join(_join(close, of, "a"), to, "b").filter("of_a <> of_b")
    sure = between.filter(F.col("bits") <= NEAR).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    near = _regrouped(rooted, sure, "wide-near")

    # Pairs that the distance leaves open, where they would join two groups.
    of = near.select(F.col("id").alias("a"), F.col("root").alias("of_a"))
    to = near.select(F.col("id").alias("b"), F.col("root").alias("of_b"))
    left = _join(_join(close.filter(F.col("bits") > NEAR), of, "a"), to, "b").filter("of_a <> of_b")
    read = _join(left, said.withColumnsRenamed({"id": "a", "said": "said_a"}), "a")
    read = _join(read, said.withColumnsRenamed({"id": "b", "said": "said_b"}), "b")
    same = read.filter(_similarity("said_a", "said_b") >= SIMILARITY).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    return _regrouped(near, same, "wide-joined")


def _regrouped(rooted: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(id, root) after links between roots."""
    found = components(links.distinct(), "a", "b").select(F.col("node").alias("root"), F.col("root").alias("group"))
    return materialised(_join(rooted, found, "root", "left").select("id", F.coalesce("group", "root").alias("root")), name)


def keep_first(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The documents without their near copies, all columns: of each group, the smallest id stays.

    Documents without an id come after all others.  Of repeated rows with the same id one
    stays, chosen by a hash of the whole row.  Texts that lower-cased have the same words are
    copies; those with fewer than five words are near nothing else.  A null text counts as
    empty, and documents without words are copies of each other.  An empty table stays empty.
    The texts are written once with their fingerprints and shuffled once to drop the copies,
    and once for the pairs whose distance leaves the similarity open.
    """
    fp, row = unused(docs, "fp"), unused(docs, "row")
    text = F.coalesce("text", F.lit("")).cast("binary")
    staged = materialised(docs.withColumns({fp: _fingerprints(text), row: F.monotonically_increasing_id()}), "wide-rows")
    order = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"), F.col(row).alias("row"),
    )
    nodes = staged.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("own")).withColumn("id", F.col("own.row"))
    nodes = materialised(nodes, "wide-nodes")
    rows = nodes.count()
    said = staged.select(F.col(row).alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("said"))
    alone = nodes.select("id", F.col("id").alias("root"))
    rooted = _joined(alone, materialised(_close(nodes, rows, bucket), "wide-pairs"), said)
    rest = materialised(_across(nodes, rows, bucket, rooted, said), "wide-rest")
    if not rest.isEmpty():
        rooted = _joined(rooted, rest, said)
    grouped = _join(nodes, rooted, "id").select("own", F.col("root").alias("group"))
    chosen = grouped.groupBy("group").agg(F.min("own").alias("first")).select(F.col("first.row").alias(row))
    return staged.join(chosen.hint("shuffle_hash"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
