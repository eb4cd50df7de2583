"""Benchmark decontamination: BM25 over the test items, block-max WAND, overlap check.

The test items are the collection and every passage of the training texts is a query.
Items are cut into segments no longer than a passage may shift, so that a copied segment
lies whole in some passage.  A term's weight in a segment is its BM25 weight over the
segment's own total, so a passage that holds all of a segment scores 1 whatever its length,
and one threshold serves all.

Posting lists are cut into blocks that know their largest weight.  Two bounds spare most
work without losing a hit.  First, for whole texts at once: each segment's commonest terms
may together stay below half the threshold; a passage in which the rarer ones do not reach
the other half cannot hit.  Second, in block-max WAND itself: a segment is scored only if
the lists that hold it, and then their blocks, can reach the threshold together.

What is retrieved is verified on the whole text by windows of five words: the share of the
item's windows that the text has, and the words so covered in its question and its answer
(its last sentence, extended backwards to a few words).

Items are held in blocks of bounded size.  Document frequencies, the number of segments and
their mean length are counted once over all items, so a hit does not depend on the blocks.
A block passes through the driver, with the frequencies of its terms, and is broadcast,
searched, its hits written and the broadcast released before the next: one is alive at a
time.  The documents pass once per block and are not shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.session import materialised

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.!?\n]+\s*")

K1, B = 1.2, 0.75
SEGMENT = 64
THRESHOLD = 0.5
SHINGLE = 5
OVERLAP = 0.8
QUESTION, ANSWER = 0.5, 0.3
ANSWER_WORDS = 8
POSTING_BLOCK = 64
ITEMS_PER_BLOCK = 20_000
CHARS_PER_BLOCK = 20_000_000

HITS = "doc_id string, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _answer_start(text: str, count: int) -> int:
    """Number of words before the answer: the last sentence, or the last few words if it is shorter."""
    ends = [m.end() for m in SENTENCE.finditer(text.rstrip(" .!?\n\t\r"))]
    before = len(tokens(text[: ends[-1]])) if ends else 0
    return max(0, min(before, count - ANSWER_WORDS))


@dataclass(frozen=True)
class Statistics:
    """Of all segments: in how many a term is, their number and mean length."""

    df: Mapping[str, int]
    n: int
    mean: float

    @classmethod
    def of(cls, segments: list[list[str]]) -> Statistics:
        return cls(Counter(t for w in segments for t in set(w)), len(segments), sum(map(len, segments)) / max(1, len(segments)))


def segments(words: list[str]) -> list[list[str]]:
    return [words[at : at + SEGMENT] for at in range(0, len(words), SEGMENT)]


class Index:
    """Inverted index of a block of items; without statistics of all items, by those of its own."""

    def __init__(self, items: list[tuple[int, str]], of_all: Statistics | None = None):
        self.items = [(item, w, _answer_start(text, len(w))) for item, text in items if (w := tokens(text))]
        parts = [(i, part) for i, (_, w, _) in enumerate(self.items) for part in segments(w)]
        self.item_of = [i for i, _ in parts]
        stats = of_all or Statistics.of([w for _, w in parts])
        df, n_all = stats.df, stats.n
        self.term = {t: k for k, t in enumerate(dict.fromkeys(t for _, w in parts for t in w))}
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        rare: dict[int, list[tuple[int, float]]] = defaultdict(list)
        self.rest = np.zeros(len(parts))
        for s, (_, w) in enumerate(parts):
            norm = K1 * (1 - B + B * len(w) / stats.mean)
            weight = {t: math.log1p((n_all - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in Counter(w).items()}
            total = math.fsum(weight.values())
            for t in sorted(weight, key=lambda t: (-df[t], t)):
                share = weight[t] / total
                postings[self.term[t]].append((s, share))
                if self.rest[s] + share <= THRESHOLD / 2:
                    self.rest[s] += share
                else:
                    rare[self.term[t]].append((s, share))
        self.lists = {t: ([s for s, _ in p], [x for _, x in p]) for t, p in postings.items()}
        self.blocks = {t: [(p[0][min(i + POSTING_BLOCK, len(p[0])) - 1], max(p[1][i : i + POSTING_BLOCK])) for i in range(0, len(p[0]), POSTING_BLOCK)] for t, p in self.lists.items()}
        self.most = {t: max(p[1]) for t, p in self.lists.items()}
        # The rare postings, term after term, for the first bound.
        self.first = np.zeros(len(self.term) + 1, dtype=np.int64)
        for t, p in rare.items():
            self.first[t + 1] = len(p)
        self.first = np.cumsum(self.first)
        flat = [x for t in range(len(self.term)) for x in rare.get(t, [])]
        self.rare_segment = np.array([s for s, _ in flat], dtype=np.int64)
        self.rare_share = np.array([x for _, x in flat])

    def passages(self, texts: list[list[str]]) -> Iterator[tuple[int, set[int]]]:
        """(text, terms) of the passages that the first bound lets through.

        A passage is two steps long and starts at every step of its text.
        """
        get, width = self.term.get, len(self.term) + 1
        sizes = np.array([len(w) for w in texts], dtype=np.int64)
        ids = np.array([get(t, -1) for w in texts for t in w], dtype=np.int64)
        start = np.cumsum(sizes) - sizes
        # Steps are numbered through; an empty one between two texts keeps their passages apart.
        steps = -(-sizes // SEGMENT) + 1
        first = np.cumsum(steps) - steps
        at = np.flatnonzero(ids >= 0)
        at = at[self.first[ids[at] + 1] > self.first[ids[at]]]
        text = np.searchsorted(start, at, side="right") - 1
        step = first[text] + (at - start[text]) // SEGMENT
        # One row per step, term and rare posting; a term counts once in a step.
        step, held = np.divmod(np.unique(step * width + ids[at]), width)
        n = self.first[held + 1] - self.first[held]
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[held], n)
        keys, where = np.unique(np.repeat(step, n) * len(self.rest) + self.rare_segment[row], return_inverse=True)
        sums = np.bincount(where, weights=self.rare_share[row], minlength=len(keys))
        # A passage has its own step and the next: both sums, or that of the one step that has any.
        low = THRESHOLD - 1e-9 - self.rest[keys % len(self.rest)]
        follows = np.flatnonzero(np.isin(keys, keys + len(self.rest)))
        both = sums.copy()
        both[np.searchsorted(keys, keys[follows] - len(self.rest))] += sums[follows]
        alone = sums.copy()
        alone[follows] = 0
        chosen = np.unique(np.concatenate([keys[both >= low] // len(self.rest), keys[alone >= low] // len(self.rest) - 1]))
        for p in chosen[chosen >= 0].tolist():
            i = int(np.searchsorted(first, p, side="right")) - 1
            begin = start[i] + (p - first[i]) * SEGMENT
            part = ids[begin : min(begin + 2 * SEGMENT, start[i] + sizes[i])]
            if len(part):
                yield i, set(part[part >= 0].tolist())

    def search(self, query: set[int]) -> dict[int, float]:
        """All segments that score the threshold or more: block-max WAND, segment after segment."""
        found: dict[int, float] = {}
        place = dict.fromkeys(query, 0)
        open_ = [t for t in query if self.lists[t][0]]
        floor = THRESHOLD - 1e-9
        while open_:
            open_.sort(key=lambda t: self.lists[t][0][place[t]])
            bound, pivot = 0.0, None
            for t in open_:
                bound += self.most[t]
                if bound >= floor:
                    pivot = self.lists[t][0][place[t]]
                    break
            if pivot is None:
                break
            # Blocks that can hold the pivot; if they cannot reach the threshold, skip to the end of the nearest.
            ahead = [t for t in open_ if self.lists[t][0][place[t]] <= pivot]
            bound, nearest = 0.0, None
            for t in ahead:
                blocks = self.blocks[t]
                b = place[t] // POSTING_BLOCK
                while b < len(blocks) and blocks[b][0] < pivot:
                    b += 1
                if b < len(blocks):
                    bound += blocks[b][1]
                    nearest = blocks[b][0] if nearest is None else min(nearest, blocks[b][0])
            if bound >= floor:
                if self.lists[ahead[0]][0][place[ahead[0]]] == pivot:
                    score = math.fsum(self.lists[t][1][place[t]] for t in ahead)
                    if score >= floor:
                        found[pivot] = score
                    target = pivot + 1
                else:
                    target = pivot
            else:
                target = max(pivot, nearest if nearest is not None else pivot) + 1
                # A list that starts later may hold a segment before that end.
                later = [self.lists[t][0][place[t]] for t in open_ if self.lists[t][0][place[t]] > pivot]
                target = max(pivot + 1, min([target, *later]))
            for t in ahead:
                place[t] = bisect_left(self.lists[t][0], target, place[t])
            open_ = [t for t in open_ if place[t] < len(self.lists[t][0])]
        return found

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, float, float]]:
        """(text, item_id, score, overlap, question_overlap, answer_overlap) of the items that the texts hold."""
        if not self.items:
            return
        split = [tokens(t) for t in texts]
        best: dict[int, dict[int, float]] = defaultdict(dict)
        for at, query in self.passages(split):
            for segment, score in self.search(query).items():
                i = self.item_of[segment]
                best[at][i] = max(best[at].get(i, 0.0), score)
        for at, found in best.items():
            yield from ((at, *hit) for hit in self.verified(split[at], found))

    def verified(self, words: list[str], best: dict[int, float]) -> list[tuple[int, float, float, float, float]]:
        """Those of the retrieved items that the text holds in their own order of words."""
        have = {size: set(zip(*(words[k:] for k in range(size)))) for size in {min(SHINGLE, len(self.items[i][1])) for i in best}}
        out = []
        for i, score in best.items():
            item, w, answer = self.items[i]
            size = min(SHINGLE, len(w))
            inside = [tuple(w[k : k + size]) in have[size] for k in range(len(w) - size + 1)]
            covered = [any(inside[max(0, k - size + 1) : k + 1]) for k in range(len(w))]
            share = lambda x: sum(x) / len(x) if x else 1.0
            overlap, question, reply = share(inside), share(covered[:answer]), share(covered[answer:])
            if overlap >= OVERLAP and question >= QUESTION and reply >= ANSWER:
                out.append((item, score, overlap, question, reply))
        return out


def indexes(items: DataFrame, rows: int = ITEMS_PER_BLOCK, chars: int = CHARS_PER_BLOCK) -> Iterator[tuple[Broadcast, bool]]:
    """The items with a text, each once, as indexes of about ``rows`` items and ``chars`` characters, and whether it is the last.

    An index is released when the next is asked for, so what is searched with it must be written by then.
    """
    spark = items.sparkSession
    clean = items.select("item_id", "text").filter("text IS NOT NULL").distinct()
    n, size = clean.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(math.ceil(n / rows), math.ceil(size / chars))
    if not blocks:
        return

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [(b, list(set(part)), len(part)) for b, text in zip(batch["block"], batch["text"]) for part in segments(tokens(text))]
            yield pd.DataFrame(parts, columns=["block", "terms", "size"])

    clean = materialised(clean.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "items")
    parts = materialised(clean.select("block", "text").mapInPandas(cut, "block int, terms array<string>, size long"), "segments")
    n_all, words = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    df = materialised(parts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    for b in range(blocks):
        own = parts.filter(F.col("block") == b).select(F.explode("terms").alias("term")).distinct().join(df, "term")
        held = clean.filter(F.col("block") == b).orderBy("item_id", "text").select("item_id", "text")
        stats = Statistics({r.term: r.df for r in own.collect()}, n_all, words / max(1, n_all))
        index = spark.sparkContext.broadcast(Index([(r.item_id, r.text) for r in held.collect()], stats))
        last = b + 1 == blocks
        yield index, last
        if not last:
            index.destroy()


def contamination(docs: DataFrame, items: DataFrame, **blocks: int) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score and overlaps.

    Null and empty texts of either table hold nothing.  A repeated item is searched once;
    of several items with one id each text counts.  Repeated documents give their rows each.
    Other columns are ignored.  Empty tables give an empty result.
    """
    spark, out = docs.sparkSession, None
    for index, _ in indexes(items, **blocks):

        def search(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            names = [f.split()[0] for f in HITS.split(", ")]
            for batch in batches:
                ids = batch["doc_id"].tolist()
                rows = [(ids[at], *hit) for at, *hit in index.value.hits(batch["text"].tolist())]
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "object", "item_id": "Int64"})

        # As text, ids survive pandas whole beside nulls.
        part = materialised(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(search, HITS), "hits")
        out = part if out is None else out.unionByName(part)
    out = spark.createDataFrame([], HITS) if out is None else out
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _clean(index: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            bad = {at for at, *_ in index.value.hits(batch.tolist())}
            yield pd.Series([at not in bad for at in range(len(batch))], dtype="bool")

    return clean


def keep_clean(docs: DataFrame, items: DataFrame, **blocks: int) -> DataFrame:
    """The documents that hold no item, all columns; they pass once per block of items.

    Null and empty texts hold nothing and stay, as do rows without an id; repeated rows stay
    or go together.  Between two blocks the documents left are written.
    """
    for index, last in indexes(items, **blocks):
        docs = docs.filter(_clean(index)(F.col("text")))
        if not last:
            docs = materialised(docs, "clean")
    return docs
