"""Toxicity scores from a weighted lexicon.

Texts are folded first, so that look-alike letters, full-width forms and digits that stand
for letters match what they imitate.  The lexicon holds beginnings of words and whole words
that labelled toxic texts have far more often than others; a likelihood ratio decides, so
chance finds in few texts stay out.  Exception phrases are pairs of words around a suspect
word that belong to harmless texts; words are weighed by what is left without them.  One Aho-Corasick pass finds all of them; the weights
that no exception covers are added, set against the text's length, and calibrated to a
probability by a logistic curve.

The fit reads a bounded number of labelled texts of either kind (``FIT_ROWS``); what it
learns has a bounded size and is broadcast.  Every text is scored whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.session import materialised

FIT_ROWS = 10_000
MOST_TERMS = 5_000
MOST_PHRASES = 5_000
PREFIXES = range(3, 8)
LEAST_RATIO = 16.0
SUSPECT_ODDS, LEAST_ODDS = 0.7, 4.0
LEAST_TEXTS = 3
SAME = 0.9
PREDICTED = 0.3

# Letters of other scripts, and signs and digits, by the Latin letter that they look like.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ь": "b", "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɩ": "i", "ɑ": "a", "ɡ": "g", "ʏ": "y", "@": "a", "$": "s", "€": "e", "£": "l",
}
DIGITS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
INVISIBLE = "­​‌‍⁠﻿"

# i, l, 1, | and ! are drawn alike and become one letter.
_TABLE = str.maketrans({**LOOK_ALIKE, "l": "i", "ӏ": "i", "£": "i", **dict.fromkeys(INVISIBLE)})
_DIGITS = str.maketrans(DIGITS)
_STROKES = re.compile(r"(?<=\w)[!|](?=\w)")
_NUMBER = re.compile(r"\d+")
_GAPS = re.compile(r"[\W_]+")


def _number(m: re.Match) -> str:
    """Digits beside a letter stand for letters."""
    beside = m.string[max(0, m.start() - 1) : m.start()] + m.string[m.end() : m.end() + 1]
    return m[0].translate(_DIGITS) if any(c.isalpha() for c in beside) else m[0]


def fold(text: str | None) -> str:
    """The text's words in folded letters, a blank before, between and after them; numbers stay numbers."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = _NUMBER.sub(_number, text.translate(_TABLE))
    if "!" in text or "|" in text:
        text = _STROKES.sub("i", text)
    return f" {_GAPS.sub(' ', text).strip()} "


def terms(folded: str) -> set[str]:
    """Whole words and beginnings of words, as they stand in a folded text."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in PREFIXES if k < len(word))
    return out


@dataclass
class Lexicon:
    """Weights of terms, exception phrases, and the curve from features to a score."""

    weights: dict[str, float]
    phrases: list[str]
    curve: tuple[float, float, float] | None = None

    def __post_init__(self) -> None:
        self.build()

    def build(self) -> None:
        self.machine = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            self.machine.add_word(term, (len(term), weight))
        for phrase in self.phrases:
            self.machine.add_word(phrase, (len(phrase), 0.0))
        if len(self.machine):
            self.machine.make_automaton()

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "phrases": self.phrases, "curve": self.curve}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.build()

    def hits(self, folded: str) -> dict[int, float]:
        """Weight of each word that begins with a lexicon term, by its place; excepted words left out."""
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        if not len(self.machine):
            return found
        for end, (size, weight) in self.machine.iter(folded):
            at = end - size + 1
            if weight:
                found[at] = max(found.get(at, 0.0), weight)
            else:
                excepted.append((at, end))
        for at, end in excepted:
            for place in [p for p in found if at <= p < end]:
                del found[place]
        return found

    def without_phrases(self, folded: str) -> str:
        """A folded text without its exception phrases."""
        if not self.phrases:
            return folded
        parts, at = [], 0
        for end, (size, weight) in self.machine.iter(folded):
            if not weight and end > at:
                parts.append(folded[at : max(at, end - size + 1)])
                at = end
        return "".join([*parts, folded[at:]])

    def features(self, folded: str) -> tuple[float, float]:
        """The weights' sum on a logarithmic scale, and set against the length."""
        total = sum(self.hits(folded).values())
        return math.log1p(total), total / math.sqrt(folded.count(" "))

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        a, b = self.features(fold(text))
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from the fit."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, text) of at most ``rows`` labelled texts of either kind, and how many there are of each."""
    clear = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    clear = clear.filter((F.col("toxic") == F.col("other")) & ~held_out(F.col("doc_id"))).drop("other")
    of = lambda kind: clear.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = of(0).unionByName(of(1)).withColumnRenamed("doc_id", "_id")
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    counts = {r.toxic: r["count"] for r in clear.groupBy("toxic").count().collect()}
    return materialised(text.select("toxic", "text"), "toxicity-fit"), counts


def _counted(texts: DataFrame, found: Callable[[str], set[str]]) -> DataFrame:
    """(term, toxic, clean): in how many texts of either kind each of what ``found`` sees in them is."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"]):
                n[int(toxic)].update(found(fold(text)))
            both = sorted(n[0].keys() | n[1].keys())
            if both:
                yield pd.DataFrame({"term": both, "toxic": [n[1][t] for t in both], "clean": [n[0][t] for t in both]})

    rows = texts.mapInPandas(count, "term string, toxic long, clean long")
    return rows.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _phrases(folded: str, lexicon: Lexicon) -> set[str]:
    """Each word that was hit, with the word before and with the word after it."""
    out = set()
    for at in lexicon.hits(folded):
        end = folded.index(" ", at + 1)
        before = folded.rfind(" ", 0, at)
        after = folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before : end + 1])
        if after >= 0:
            out.add(folded[at : after + 1])
    return out


def _narrowest(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Weights of the terms without the beginnings that a longer term replaces in nearly all toxic texts."""
    replaced = {
        term[:k] for term, (toxic, _) in found.items() for k in range(2, len(term))
        if term[:k] in found and toxic >= SAME * found[term[:k]][0]
    }
    return {term: odds for term, (_, odds) in found.items() if term not in replaced}


def _ratio(n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """Log likelihood ratio (G squared) of a term's counts against the rates of the sample, and its log odds."""
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rate = n_toxic / (n_toxic + n_clean)
    part = lambda x, of: F.when(x > 0, x * F.log(x / ((t + c) * of))).otherwise(0.0)
    odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    return 2 * (part(t, rate) + part(c, 1 - rate)), odds


def _chosen(counted: DataFrame, n_toxic: int, n_clean: int, least: float) -> dict[str, float]:
    """The terms that set toxic texts apart most clearly, with their log odds."""
    ratio, odds = _ratio(n_toxic, n_clean)
    scored = counted.filter(F.col("toxic") >= LEAST_TEXTS).select("term", "toxic", ratio.alias("ratio"), odds.alias("odds"))
    best = scored.filter((F.col("odds") >= least) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.desc("ratio"), "term").limit(MOST_TERMS)
    return _narrowest({r.term: (r.toxic, r.odds) for r in best.collect()})


def _harmless(counted: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """The phrases that set other texts apart."""
    ratio, odds = _ratio(n_toxic, n_clean)
    scored = counted.filter(F.col("clean") >= LEAST_TEXTS).select("term", ratio.alias("ratio"), odds.alias("odds"))
    best = scored.filter((F.col("odds") < 0) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.desc("ratio"), "term").limit(MOST_PHRASES)
    return [r.term for r in best.collect()]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with a small penalty on the slopes."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ beta)
        # A long step would leave the range in which the curve is known.
        beta += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Lexicon:
    """A lexicon from at most ``rows`` labelled texts of either kind; rows held out are not read for it."""
    texts, counts = _sample(docs, labels, rows)
    read = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = read.get(1, 0), read.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, [])
    share = docs.sparkSession.sparkContext.broadcast

    frequent = materialised(_counted(texts, terms).filter(F.col("toxic") >= LEAST_TEXTS), "toxicity-terms")
    suspects = share(Lexicon(_chosen(frequent, n_toxic, n_clean, SUSPECT_ODDS), []))
    phrases = _harmless(_counted(texts, lambda folded: _phrases(folded, suspects.value)), n_toxic, n_clean)
    excepted = share(Lexicon({}, phrases))
    left = _counted(texts, lambda folded: terms(excepted.value.without_phrases(folded))) if phrases else frequent
    lexicon = Lexicon(_chosen(left, n_toxic, n_clean, LEAST_ODDS), phrases)
    shared = share(lexicon)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.features(fold(t)) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "a": [f[0] for f in found], "b": [f[1] for f in found]})

    points = texts.mapInPandas(measured, "toxic int, a double, b double").toPandas()
    y = points["toxic"].to_numpy(dtype=float)
    # Sampled kinds count as often as they are among the labels.
    weight = np.where(y == 1, counts[1] / n_toxic, counts[0] / n_clean)
    return Lexicon(lexicon.weights, phrases, _curve(points[["a", "b"]].to_numpy(), y, weight))


def _scorer(lexicon: Broadcast) -> Column:
    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([lexicon.value.score(t) for t in batch], dtype="float64")

    return score


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no hits and get the score of such a text.  Documents without
    an id have no label and are not held out.  Labels that contradict each other, or are
    neither 0 nor 1, are not used; without labels of both kinds every score is 0.  Repeated
    rows are scored alike; other columns are ignored.  An empty table gives an empty result.
    """
    lexicon = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _scorer(lexicon)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICTED).cast("int"))
