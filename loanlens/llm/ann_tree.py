"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted to a bounded sample of directions; every vector then goes down to one leaf.
A query walks the tree best bin first: a priority queue holds the branches not taken, nearest
centre first, and leaves are visited in that order.  How many is calibrated: bounded many
queries are answered by brute force over all vectors, and visits widen until the leaves hold
``RECALL`` of their true neighbours.  A search never ends before its leaves hold enough
vectors, so a small table gives all there are.

Equal vectors are searched once.  They share one class, of which the smallest ids suffice, one
more than neighbours are wanted; so a vector with very many copies is one row.  Leaves are cut
into blocks by size, and so are the queries of a leaf: a task compares one block of vectors
with one block of queries, and what leaves it is some neighbours a query.

Nearness is the cosine in double precision on the vectors as given, ties to the smaller id.
Vectors that are null, zero or hold a null, NaN or infinite component take no part, nor do rows
without an id.  Vectors of different lengths are never near each other; the tree sees them
cut or filled with zeros.  Rows that repeat an id and a vector count once; an id's further
vectors are candidates and queries of their own, and no id is its own neighbour.  Columns other than the
two named play no part; an empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import materialised

NEIGHBOURS = 5
# Vectors that the tree is fitted to, at most twice as many.
SAMPLE = 20_000
# Children of a node at most, and vectors of the sample that make a leaf at least.  Leaves are more
# with more rows: half as many as the square root of their number.
BRANCHES = 8
LEAF = 32
ROUNDS = 8
# Queries for the calibration, and the share of their true neighbours to be reached.
PROBES = 256
RECALL = 0.96
# Rows of a block, of vectors and of queries.
BLOCK = 4_096


@dataclass
class Node:
    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    length: int
    leaves: int

    def place(self, units: np.ndarray) -> np.ndarray:
        """The leaf of every row, always going to the nearest centre."""
        leaf = np.zeros(len(units), dtype=np.int64)
        todo = [(self.root, np.arange(len(units)))]
        while todo:
            node, rows = todo.pop()
            if node.centres is None:
                leaf[rows] = node.leaf
                continue
            nearest = np.argmax(units[rows] @ node.centres.T, axis=1)
            todo += [(child, rows[nearest == i]) for i, child in enumerate(node.children) if (nearest == i).any()]
        return leaf

    def visits(self, unit: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue, turn = [(0.0, 0, self.root)], 1
        while queue:
            _, _, node = heapq.heappop(queue)
            if node.centres is None:
                yield node.leaf
                continue
            for far, child in zip((-(node.centres @ unit)).tolist(), node.children):
                heapq.heappush(queue, (far, turn, child))
                turn += 1


def fit(units: np.ndarray, leaf: float = LEAF) -> Tree:
    """A tree over rows of length 1, with leaves of so many rows at most; the same for the same rows."""
    random = np.random.default_rng(42)
    leaves = 0

    def split(rows: np.ndarray) -> Node:
        nonlocal leaves
        if len(rows) > leaf:
            x = units[rows]
            n = int(min(BRANCHES, -(-len(x) // leaf)))
            centres = x[random.choice(len(x), n, replace=False)]
            for _ in range(ROUNDS):
                own = np.argmax(x @ centres.T, axis=1)
                sums = np.stack([x[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(n)])
                centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)
            own = np.argmax(x @ centres.T, axis=1)
            used = np.unique(own)
            if len(used) > 1:
                return Node(centres[used], [split(rows[own == i]) for i in used])
        leaves += 1
        return Node(leaf=leaves - 1)

    root = split(np.arange(len(units)))
    return Tree(root, units.shape[1], leaves)


def units(vectors: Iterable[np.ndarray], length: int) -> np.ndarray:
    """Rows of length 1, cut or filled to so many components."""
    out = np.zeros((len(vectors), length))
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector[:length]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def classes(df: DataFrame, key: str, vector: str, most: int) -> DataFrame:
    """(class, vector, ids): different vectors with their smallest ids, as many as can matter."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    # Two hashes with different seeds: 128 bits name a vector.
    name = F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b"))
    rows = rows.select("id", "vector", name.alias("class"))
    # Only names and ids are ranked; a vector goes through one shuffle, a copy of it through none.
    named = rows.select("class", "id").distinct()
    place = F.row_number().over(Window.partitionBy("class").orderBy("id"))
    few = named.withColumn("place", place).filter(F.col("place") <= most)
    ids = few.groupBy("class").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return rows.groupBy("class").agg(F.any_value("vector").alias("vector")).join(ids, "class")


def _sample(rows: DataFrame, total: int, most: int) -> list:
    """About so many vectors, by their hash; twice as many at most."""
    share = int(min(1.0, most / max(total, 1)) * (1 << 30))
    point = F.pmod(F.col("class.b"), F.lit(1 << 30))
    return [r.vector for r in rows.filter(point < share).orderBy("class").limit(2 * most).select("vector").collect()]


def _exact(queries: np.ndarray, lengths: np.ndarray, rows: DataFrame, k: int) -> pd.DataFrame:
    """(probe, score, leaf) of the nearest rows to bounded many queries, by brute force in every task."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, lengths))

    def near(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, lengths = shared.value
        best = pd.DataFrame({"probe": [], "score": [], "leaf": []})
        for batch in batches:
            if batch.empty:
                continue
            scores = queries @ units(list(batch["vector"]), queries.shape[1]).T
            scores[lengths[:, None] != batch["vector"].map(len).to_numpy()[None, :]] = -2
            top = np.argsort(-scores, axis=1)[:, :k]
            probe = np.repeat(np.arange(len(queries)), top.shape[1])
            new = pd.DataFrame({"probe": probe, "score": np.take_along_axis(scores, top, 1).ravel(), "leaf": batch["leaf"].to_numpy()[top].ravel()})
            best = pd.concat([best, new[new["score"] > -2]]).sort_values(["probe", "score"], ascending=[True, False]).groupby("probe").head(k)
        yield best.astype({"probe": "int64", "leaf": "int64"})

    found = rows.select("vector", "leaf").mapInPandas(near, "probe long, score double, leaf long")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "leaf"))
    return found.withColumn("place", place).filter(F.col("place") <= k).select("probe", "score", "leaf").toPandas()


def calibrate(tree: Tree, probes: list, rows: DataFrame, k: int) -> int:
    """The fewest leaf visits whose leaves hold ``RECALL`` of the probes' true neighbours."""
    if not probes or tree.leaves == 1:
        return 1
    vectors = [np.asarray(p) for p in probes]
    # The nearest is the probe itself.
    found = _exact(units(vectors, max(map(len, vectors))), np.array([len(v) for v in vectors]), rows, k + 1)
    at = units(vectors, tree.length)
    ranks = []
    for probe, group in found.groupby("probe"):
        order = {leaf: i for i, leaf in enumerate(tree.visits(at[int(probe)]), 1)}
        ranks += [order[leaf] for leaf in group.sort_values("score", ascending=False)["leaf"].iloc[1:]]
    return int(np.quantile(ranks, RECALL, method="higher")) if ranks else 1


def _leaf_of(tree) -> Column:
    @F.pandas_udf("long")
    def leaf(vectors: pd.Series) -> pd.Series:
        return pd.Series(tree.value.place(units(list(vectors), tree.value.length)))

    return leaf


def _route(tree, held) -> Column:
    @F.pandas_udf("array<long>")
    def route(vectors: pd.Series) -> pd.Series:
        (sizes, visits, least), out = held.value, []
        for unit in units(list(vectors), tree.value.length):
            taken, seen = [], 0
            for leaf in tree.value.visits(unit):
                if len(taken) >= visits and seen >= least:
                    break
                taken.append(leaf)
                seen += sizes[leaf]
            out.append([leaf for leaf in taken if sizes[leaf]])
        return pd.Series(out)

    return route


def _compare(k: int):
    """The nearest classes of a block to each query of a block, scored on the vectors as given."""

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for length in set(queries["length"]) & set(rows["length"]):
            q, r = queries[queries["length"] == length], rows[rows["length"] == length].sort_values("first")
            c = np.stack(r["vector"].to_list())
            c_norm = np.sqrt((c * c).sum(axis=1))
            ids, most = r["ids"].to_numpy(), min(k, len(c))
            for low in range(0, len(q), 256):
                part = q.iloc[low : low + 256]
                x = np.stack(part["vector"].to_list())
                x_norm = np.sqrt((x * x).sum(axis=1))
                near = (x @ c.T) / c_norm / x_norm[:, None]
                limit = np.partition(near, len(c) - most, axis=1)[:, len(c) - most]
                # Those within rounding of the k-th are scored one by one, always alike.
                i, j = np.nonzero(near >= limit[:, None] - 1e-9)
                score = (x[i] * c[j]).sum(axis=1) / (x_norm[i] * c_norm[j])
                # Rows stand by their smallest id, which decides ties.
                order = np.lexsort((j, -score, i))
                i, j, score = i[order], j[order], score[order]
                first = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j, score = i[first], j[first], score[first]
                each = np.array([len(ids[n]) for n in j])
                out.append(pd.DataFrame({
                    "a": np.repeat(part["a"].to_numpy()[i], each), "b": np.repeat(part["b"].to_numpy()[i], each),
                    "vec_id": np.concatenate([ids[n] for n in j]), "score": np.repeat(score, each),
                }))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "vec_id": [], "score": []})

    return compare


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` marks, the nearest rows found."""
    spark = df.sparkSession
    rows = materialised(classes(df, key, vector, k + 1), "vectors")
    total = rows.count()
    sample = _sample(rows, total, SAMPLE) or [[1.0]]
    tree = fit(units(sample, max(map(len, sample))), max(LEAF, 2 * len(sample) / max(total, 1) ** 0.5))
    shared = spark.sparkContext.broadcast(tree)
    rows = materialised(rows.withColumn("leaf", _leaf_of(shared)("vector")), "leaves")

    # Each row that asks, with the class of its vector; a class asks once.
    asking = classes(df.filter(is_query), key, vector, 1).select("class", "vector")
    asking = materialised(asking, "queries")
    visits = calibrate(tree, _sample(asking, asking.count(), PROBES), rows, k)
    sizes = {r.leaf: r.n for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = spark.sparkContext.broadcast(([sizes.get(i, 0) for i in range(tree.leaves)], visits, k + 1))
    routed = materialised(asking.withColumn("leaf", F.explode(_route(shared, held)("vector"))), "visits")

    # Blocks of a leaf, of its rows and of its queries, by their numbers; one row per leaf.
    def blocks(frame: DataFrame, name: str) -> DataFrame:
        return frame.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))

    of = blocks(rows, "n_rows").join(blocks(routed, "n_queries"), "leaf")
    part = F.col("class.a")

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        # Both sides need the same types for their hashes to agree.
        mine, theirs = F.pmod(part, F.col(f"n_{own}")).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(f"n_{other}").cast("int") - 1)).alias(other)
        extra = [F.col("ids"), F.col("ids")[0].alias("first")] if own == "rows" else []
        return frame.join(F.broadcast(of), "leaf").select("leaf", mine, theirs, "class.a", "class.b", "vector", F.size("vector").alias("length"), *extra)

    cell = ("leaf", "rows", "queries")
    kind = dict(df.dtypes)[key]
    found = dealt(routed, "queries", "rows").groupBy(*cell).cogroup(dealt(rows, "rows", "queries").groupBy(*cell)).applyInPandas(
        _compare(k + 1), f"a long, b long, vec_id {kind}, score double")
    nearest = Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id")
    found = found.distinct().withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1).drop("place")

    asked = df.filter(is_query).select(F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("vector")).filter(F.col("vector").isNotNull())
    asked = asked.select("query_id", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b")).distinct()
    out = asked.join(found, ["a", "b"]).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "a", "b").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
