"""Near-duplicate groups by SimHash and pigeonhole blocks.

A text's fingerprint has 64 bits; texts link if their fingerprints differ in a few bits.
The fingerprint is cut into more blocks than bits may differ, so a close pair agrees on
all blocks but as many as those bits.  Every choice of blocks that must agree is a key;
fingerprints are joined on the keys, and the Hamming distance is verified.

Equal fingerprints are one node from the start, so a group of exact copies costs nothing.
Inside a bucket of fingerprints that agree on a key, each is compared with the next
``BUCKET`` in order, which is all of them unless the bucket is larger.  In a larger bucket
every fingerprint also gives one key for each set of bits that may differ outside the
agreed blocks, with those bits cleared; equal keys link.  That is as exact, and its work
grows with the number of fingerprints, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.components import components
from loanlens.llm.text import unused
from loanlens.session import materialised

BITS = 64
BLOCKS = 5
BUCKET = 64
SHINGLE = 3
# The shingle hash is XXH64 with this seed.
SEED = 42
# Shingles whose bits are counted at a time; bounds the memory of very long texts.
CHUNK = 1 << 15

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(text: bytes, size: int, kind: str = "u8") -> np.ndarray:
    """Hashes of a UTF-8 text's shingles of words, A-Z lower-cased, repeats included.

    A text with fewer words than a shingle is one shingle; one without words has none.
    """
    # bytes.lower and bytes.split know just the ASCII letters and the six ASCII blanks.
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=kind)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) > size else [b" ".join(words)]
    return np.fromiter(map(_hash, shingles), dtype=kind, count=max(1, len(words) - size + 1))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the shingles' hashes, 0 throughout without words."""
    hashes = shingle_hashes(text, size, ">u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def fingerprint_of(text: Column) -> Column:
    """The fingerprint of a text column as a signed number; null counts as empty."""
    return _fingerprints(F.coalesce(text, F.lit("")).cast("binary"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _blocks(count: int) -> list[int]:
    """Bit masks of ``count`` blocks of nearly equal width."""
    cuts = [BITS * i // count for i in range(count + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]


def links(nodes: DataFrame, distance: int = 2, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``nodes`` at most ``distance`` bits apart.

    The links keep every pair connected; in an oversized bucket they lead to the smallest of
    those that differ in the same bits instead of naming every pair.
    """
    if not 0 < distance < blocks:
        raise ValueError("a close pair must agree on a block")
    masks = _blocks(blocks)
    agreed = [sum(masks[i] for i in keep) for keep in combinations(range(blocks), blocks - distance)]
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(agreed)])
    spread = nodes.select("fp", F.explode(keys).alias("b")).select("fp", "b.k", "b.key")
    same = Window.partitionBy("k", "key")
    following = same.orderBy("fp").rowsBetween(1, bucket)
    dealt = spread.withColumns({"n": F.count(F.lit(1)).over(same), "next": F.collect_list("fp").over(following)})
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = dealt.filter("n > 1").select(F.col("fp").alias("a"), F.explode("next").alias("b")).filter(near)
    # Oversized buckets: clear each set of bits outside the agreed blocks.
    free = [[b for b in range(BITS) if not m >> b & 1] for m in agreed]
    cleared = F.array(*[F.array(*[F.lit(_signed((1 << BITS) - 1 - sum(1 << b for b in bits))) for bits in combinations(own, distance)]) for own in free])
    big = dealt.filter(F.col("n") > bucket + 1).select("k", "fp", F.explode(F.get(cleared, F.col("k"))).alias("mask"))
    big = big.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    hubs = big.groupBy("k", "mask", "key").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    stars = hubs.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).filter("a <> b")
    return pairs.unionByName(stars).distinct()


def groups(narrow: DataFrame, node: str, distance: int = 2, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """(fp, first): the smallest ``node`` of the component of each distinct fingerprint.

    ``narrow`` holds fp and ``node``, which may be a struct; null nodes are passed over.
    """
    nodes = materialised(narrow.groupBy("fp").agg(F.min(node).alias("own")), "fingerprints")
    found = components(links(nodes.select("fp"), distance, blocks, bucket), "a", "b").withColumnRenamed("node", "fp")
    linked = nodes.join(found, "fp")
    smallest = linked.groupBy("root").agg(F.min("own").alias("first"))
    first = linked.join(smallest, "root").select("fp", "first")
    return nodes.join(first, "fp", "left").select("fp", F.coalesce("first", "own").alias("first"))


def near_duplicates(docs: DataFrame, distance: int = 2, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    ``component_id`` is the smallest doc_id that can be reached over links, the document's
    own included; null if none of the component has an id.  Null text counts as empty;
    documents without words share fingerprint 0 and link like any other.  Repeated rows
    come back as often as they were given; other columns are ignored.  An empty table
    gives an empty result.
    """
    narrow = materialised(docs.select("doc_id", fingerprint_of(F.col("text")).alias("fp")), "simhash")
    found = groups(narrow, "doc_id", distance, blocks, bucket)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return narrow.join(found, "fp").select("doc_id", digits.alias("fingerprint"), F.col("first").alias("component_id"))


def keep_first(docs: DataFrame, distance: int = 2, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """The documents without their near copies, all columns: of each component, the smallest id stays.

    Documents without an id come after all others.  Of repeated rows with the same id one
    stays, chosen by a hash of the whole row.  The texts are written once with their
    fingerprints, and shuffled once to drop the copies.
    """
    fp, row = unused(docs, "fp"), unused(docs, "row")
    staged = docs.withColumns({fp: fingerprint_of(F.col("text")), row: F.monotonically_increasing_id()})
    staged = materialised(staged, "simhash-rows")
    order = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"), F.col(row).alias("row"),
    )
    narrow = materialised(staged.select(F.col(fp).alias("fp"), order.alias("node")), "simhash")
    found = groups(narrow, "node", distance, blocks, bucket)
    chosen = found.select(F.col("first.row").alias(row)).distinct()
    return staged.join(chosen.hint("shuffle_hash"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
