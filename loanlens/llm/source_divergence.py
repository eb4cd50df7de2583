"""How far the sources of a language diverge in their words, exactly.

Identical texts of a language are collapsed first: a text's copies are counted by source,
one of them is tokenized, and its terms count in each source as often as it stands there.
Tasks add up before they pass rows on, and a term travels with all its sources in one row;
rows are dealt by language and term, and stay so until the terms that are in enough of the
language's documents are written, again a row each.  Each source and the language as a whole then has an integer share for every kept term, in
thousand millionths, and two shares differ by floor((p - q)^2 / (p + q)).

Pairs of sources are evaluated sparsely.  All terms that a source lacks have one share, so a
pair's sum is that of two empty sources for every kept term, corrected for the terms of the
one, for those of the other (by how many terms have a count: a histogram), and once more for
the terms that both have.  Those come from the rows of the terms, without a join.

The result is whole numbers throughout; nothing is rounded but by the definitions above.
Null text, language and source count as ''.  Repeated rows and ids are documents each.  A
source without terms has the shares of zero counts; a language without kept terms gives 0
for each pair and no terms.  Other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import materialised

LEAST_DOCS = 10
TOP_TERMS = 10

# Letters of ASCII and all characters beyond it make terms; only A-Z have a lower case.
# On UTF-8: every byte of a character beyond ASCII is above 0x7F.  All other bytes become blanks.
_LOWER = bytes(c if c >= 0x80 else ord(chr(c).lower() if chr(c).isalpha() else " ") for c in range(256))

# Terms of all sources that a task holds before it passes their counts on.
HELD = 400_000

PLACES = pa.struct([("source", pa.string()), ("docs", pa.int64()), ("n", pa.int64())])


def collapsed(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, text, places): each different text of a language once, with (source, copies) for each of its sources.

    Copies are added up inside the tasks before they are dealt out, so that a text with very
    many of them is no large group.
    """
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    rows = rows.withColumn("digest", F.sha2("text", 256))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("copies"))
    places = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "copies")).alias("places"))
    return rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text")).join(places, ["lang", "digest"]).select("lang", "text", "places")


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, lower-cased."""
    return text.translate(_LOWER).split()


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # By language and source: documents with a term, and occurrences.
    sums: dict[str, dict[str, tuple[Counter[bytes], Counter[bytes]]]] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, places_of in sums.items():
            each = pa.array(chain.from_iterable(occurring for _, occurring in places_of.values()), pa.binary()).dictionary_encode()
            at = each.indices.to_numpy()
            order = np.argsort(at, kind="stable")
            source = np.repeat(np.arange(len(places_of), dtype=np.int32), [len(occurring) for _, occurring in places_of.values()])
            docs = np.fromiter(chain.from_iterable(map(having.__getitem__, occurring) for having, occurring in places_of.values()), np.int64, len(at))
            n = np.fromiter(chain.from_iterable(occurring.values() for _, occurring in places_of.values()), np.int64, len(at))
            sources = pa.array(list(places_of), pa.string()).take(pa.array(source[order]))
            places = pa.StructArray.from_arrays([sources, pa.array(docs[order]), pa.array(n[order])], fields=list(PLACES))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(each.dictionary)))]).astype(np.int32))
            langs = pa.repeat(pa.scalar(lang, pa.string()), len(each.dictionary))
            arrays = [langs, each.dictionary.cast(pa.string()), pa.ListArray.from_arrays(ends, places)]
            yield from pa.Table.from_arrays(arrays, ["lang", "term", "places"]).to_batches(max_chunksize=10_000)

    held = 0
    for batch in batches:
        langs, texts, places_of = batch.columns
        for lang, text, places in zip(langs.to_pylist(), texts.cast(pa.large_binary()).to_pylist(), places_of.to_pylist()):
            terms = terms_of(text)
            different = set(terms)
            for place in places:
                copies = place["copies"]
                having, occurring = sums.setdefault(lang, {}).setdefault(place["source"], (Counter(), Counter()))
                held -= len(occurring)
                if copies == 1:
                    having.update(different)
                    occurring.update(terms)
                else:
                    for term, n in Counter(terms).items():
                        having[term] += copies
                        occurring[term] += copies * n
                held += len(occurring)
                if held > HELD:
                    yield from counted()
                    sums.clear()
                    held = 0
    yield from counted()


def kept_terms(texts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, of_lang, places) of collapsed texts: occurrences, in all and by source, of terms in enough documents."""
    counts = texts.mapInArrow(_count, "lang string, term string, places array<struct<source:string,docs:long,n:long>>")
    # Dealt once; what follows keeps a term's rows where they are.
    counts = counts.repartition("lang", "term").select("lang", "term", F.inline("places"))
    by_source = counts.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("of_lang"), F.collect_list(F.struct("source", "n")).alias("places")
    )
    return terms.filter(F.col("docs") >= least_docs).drop("docs")


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)); on decimals where the product could pass the whole numbers of 64 bits."""
    return F.expr(
        f"1 + case when {n} <= 9000000000 then 1000000000L * ({n} + 2) div ({total} + 2 * {kept}) else "
        f"(cast(1000000000 as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div cast({total} + 2 * {kept} as decimal(20,0)) end"
    )


def differ(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): the pairs with other sources, and the terms above the language's share."""
    empty = F.lit("")
    groups = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source")).distinct()
    kept = materialised(kept_terms(collapsed(docs, text, lang, source)), "terms")
    counts = kept.select("lang", "term", "of_lang", F.inline("places"))

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), "lang_total")
    )
    # The share of a term that the group lacks; none where nothing is kept.
    groups = materialised(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "total", "v"))), "totals")
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "p0", share("n", "total", "v").alias("p"),
                                                            share("of_lang", "lang_total", "v").alias("q"))

    terms = shares.filter("n > 0 and p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), differ("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_TERMS)
    pairs = _pairs(groups, shares, kept).withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)


def _pairs(groups: DataFrame, shares: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) for each two sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "source", "v", "p0").join(other, "lang").filter("source <> item")
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("v") * differ("p0", "q0"), F.lit(0)).alias("value"))
    # Terms of the one against the other's lack of them; the same number serves both directions.
    counted = shares.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("terms"))
    one = counted.join(other, "lang").filter("source <> item")
    one = one.select("lang", "source", "item", (F.col("terms") * (differ("p", "q0") - differ("p0", "q0"))).alias("value"))
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    # Terms of both, each pair of sources once: every place of a term with those that follow it.
    places = F.array_sort("places")
    first = kept.select("lang", places.alias("places")).select("lang", "places", F.posexplode("places").alias("i", "x"))
    rest = F.explode(F.slice("places", F.col("i") + 2, F.size("places"))).alias("y")
    a = first.select("lang", "x.source", F.col("x.n").alias("n"), rest)
    a = a.join(groups, ["lang", "source"]).select("lang", "source", "p0", share("n", "total", "v").alias("p"), F.col("y.source").alias("item"), F.col("y.n").alias("n"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), "total", "v")
    both = a.join(b, ["lang", "item"]).withColumn("q", share("n", "total", "v"))
    both = both.select("lang", "source", "item", (differ("p", "q") - differ("p", "q0") - differ("p0", "q") + differ("p0", "q0")).alias("value"))
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    mirrored = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = base.unionByName(one).unionByName(turned).unionByName(both).unionByName(mirrored)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
