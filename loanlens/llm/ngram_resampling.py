"""Documents drawn for how much more likely a target's texts are to hold their n-grams.

Features are the runs of one to three words; each has a bucket.  Both corpora are counted by
bucket, a bucket's gain is the logarithm of the two smoothed shares' ratio, and a document's
weight is the sum of its features' gains.  Gumbel noise of the document's id is added, so
that taking the highest scores is a draw without replacement in proportion to the weights.

Features are interned by the batch: an open-addressed table holds, for each different n-gram,
its bucket and its count, found by XXH64 and verified byte by byte.  A task holds one text,
or about a megabyte of them, and the table of so many occurrences; longer texts pass in
parts.  Two scans read the texts; what the driver gets is one count per bucket and scan.
Ranks need no sort in one task: rows are dealt by ranges of the score, numbered inside each
range, and the ranges' sizes are added up.

Null texts are empty: no features, weight 0.  A null id counts as an empty string for the
noise.  Repeated rows count and compete each on their own, also under one id; equal rows
share their ranks in any order.  An empty target or table works; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.session import materialised

BUCKETS = 10_000
LONGEST = 3
SEED = 42
PERCENT = 5
LEAST_WORDS = 20

# Bytes of text brought together, and occurrences interned at a time.
CHUNK = 1 << 20
SPANS = 1 << 18
# Bytes of a feature up to which those of one size are hashed side by side.
SHORT = 96

# Letters lower-cased, and the bytes of words.  All of a character beyond ASCII are.
_LOWER = bytes(range(256)).lower()
_IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
# The multipliers of XXH64, and the reversed polynomial of CRC-32.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_POLYNOMIAL = 0xEDB88320
# What is left of eight bytes when a span ends after so many of them.
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        table = np.where(table & np.uint64(1), table >> np.uint64(1) ^ np.uint64(_POLYNOMIAL), table >> np.uint64(1))
    return table


_CRC = _crc_table()


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _round(sums: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _turn(sums + lane * _P2, 31) * _P1


def _xxh64(lanes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """XXH64, seed 0, of spans of one size."""
    at, zero = 0, np.uint64(0)
    if size >= 32:
        sums = [np.full(len(start), zero) + x for x in (_P1, zero, zero, zero)]
        sums = [sums[0] + _P2, sums[1] + _P2, sums[2], sums[3] - _P1]
        while size - at >= 32:
            sums = [_round(x, lanes[start + at + 8 * i]) for i, x in enumerate(sums)]
            at += 32
        h = _turn(sums[0], 1) + _turn(sums[1], 7) + _turn(sums[2], 12) + _turn(sums[3], 18)
        for x in sums:
            h = (h ^ _round(zero, x)) * _P1 + _P4
    else:
        h = np.full(len(start), _P5)
    h += np.uint64(size)
    while size - at >= 8:
        h = _turn(h ^ _round(zero, lanes[start + at]), 27) * _P1 + _P4
        at += 8
    if at < size:
        # The last bytes, fewer than eight, are in one lane.
        rest = lanes[start + at]
        if size - at >= 4:
            h = _turn(h ^ (rest & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
            rest, at = rest >> np.uint64(32), at + 4
        for _ in range(size - at):
            h = _turn(h ^ (rest & np.uint64(255)) * _P5, 11) * _P1
            rest = rest >> np.uint64(8)
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    return h ^ h >> np.uint64(32)


def _crc32(lanes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """CRC-32 of spans of one size."""
    crc = np.full(len(start), np.uint64(0xFFFFFFFF))
    for at in range(0, size, 8):
        rest = lanes[start + at]
        for _ in range(min(8, size - at)):
            crc = _CRC[(crc ^ rest) & np.uint64(255)] ^ crc >> np.uint64(8)
            rest = rest >> np.uint64(8)
    return crc ^ np.uint64(0xFFFFFFFF)


class Words:
    """The words of some texts in one buffer, each followed by one blank."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer((b"\0".join(texts) + b"\0").translate(_LOWER), dtype=np.uint8)
        inside = _IN_WORD[data]
        before = np.concatenate(([False], inside[:-1]))
        begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
        self.owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")
        self.size = end - begin
        self.start = np.cumsum(self.size + 1) - self.size - 1
        kept = np.where(inside, data, 32)[inside | before].astype(np.uint8)
        self.buffer = kept.tobytes() + bytes(8)
        # Eight bytes at every position; side by side in memory unless a text is very long.
        lanes = np.ndarray((len(self.buffer) - 7,), "<u8", self.buffer, strides=(1,))
        self.lanes = np.ascontiguousarray(lanes) if len(lanes) <= 8 * CHUNK else lanes

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Start, size and text of the occurrences, in parts of at most ``SPANS``."""
        for n in range(1, LONGEST + 1):
            for low in range(0, len(self.start) - n + 1, SPANS):
                first = np.arange(low, min(low + SPANS, len(self.start) - n + 1))
                first = first[self.owner[first] == self.owner[first + n - 1]]
                last = first + n - 1
                yield self.start[first], self.start[last] + self.size[last] - self.start[first], self.owner[first]

    def hashed(self, start: np.ndarray, size: np.ndarray, short, long) -> np.ndarray:
        """A hash of every span: ``short`` takes all spans of one size at once, ``long`` the bytes of one."""
        out = np.empty(len(start), dtype=np.uint64)
        order = np.argsort(np.minimum(size, SHORT + 1).astype(np.uint16), kind="stable")
        ends = np.cumsum(np.bincount(np.minimum(size, SHORT + 1), minlength=SHORT + 2))
        for n in range(1, SHORT + 1):
            rows = order[ends[n - 1] : ends[n]]
            if len(rows):
                out[rows] = short(self.lanes, start[rows], n)
        for row in order[ends[SHORT] :].tolist():
            out[row] = long(self.buffer[start[row] : start[row] + size[row]])
        return out

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes at ``a`` and at ``b`` are equal, eight at a time."""
        equal, rest, done = np.ones(len(a), dtype=bool), np.flatnonzero(a != b), 0
        while rest.size:
            left = size[rest] - done
            differs = (self.lanes[a[rest] + done] ^ self.lanes[b[rest] + done]) & _TAIL[np.minimum(left, 8)] != 0
            equal[rest[differs]] = False
            rest = rest[~differs & (left > 8)]
            done += 8
        return equal


class Table:
    """Different n-grams among some occurrences: slots with bucket and count."""

    def __init__(self, words: Words, start: np.ndarray, size: np.ndarray) -> None:
        n = len(start)
        keys = words.hashed(start, size, _xxh64, xxhash.xxh64_intdigest)
        mask = (1 << (2 * n).bit_length()) - 1
        holder = np.full(mask + 1, -1)
        slot = (keys & np.uint64(mask)).astype(np.int64)
        todo = np.arange(n)
        while todo.size:
            wanted = slot[todo]
            free = holder[wanted] < 0
            # One of those that want a free slot gets it, the others compare themselves with it.
            holder[wanted[free]] = todo[free]
            held = holder[wanted]
            found = (keys[held] == keys[todo]) & (size[held] == size[todo])
            maybe = np.flatnonzero(found)
            found[maybe] = words.same(start[held[maybe]], start[todo[maybe]], size[todo[maybe]])
            todo = todo[~found]
            slot[todo] = (slot[todo] + 1) & mask
        self.slot = slot
        self.used = np.flatnonzero(holder >= 0)
        own = holder[self.used]
        self.bucket = np.zeros(mask + 1, dtype=np.int64)
        self.bucket[self.used] = words.hashed(start[own], size[own], _crc32, zlib.crc32) % np.uint64(BUCKETS)
        self.count = np.bincount(slot, minlength=mask + 1)


def _chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts in order, so many at a time as make up ``CHUNK`` bytes, or one."""
    chunk, size = [], 0
    for text in texts.cast(pa.large_binary()).to_pylist():
        text = text or b""
        if chunk and size + len(text) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def bucket_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): occurrences of features by bucket, added up in each task first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for texts in _chunks(batch.column(0)):
                words = Words(texts)
                for start, size, _ in words.features():
                    table = Table(words, start, size)
                    np.add.at(total, table.bucket[table.used], table.count[table.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return df.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(df: DataFrame, text: str) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in bucket_counts(df, text).collect():
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm by which a bucket's share is larger in the target, rounded down."""
    above = (target + 1.0) * (float(corpus.sum()) + BUCKETS)
    below = (corpus + 1.0) * (float(target.sum()) + BUCKETS)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def noise(key: Column) -> Column:
    """Thousandths of a Gumbel variate that the key's SHA-256 decides, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weights(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            parts = []
            for texts in _chunks(batch.column(1)):
                words = Words(texts)
                n_words = np.bincount(words.owner, minlength=len(texts))
                n_features, weight = np.zeros_like(n_words), np.zeros(len(texts), dtype=np.int64)
                for start, size, owner in words.features():
                    table = Table(words, start, size)
                    n_features += np.bincount(owner, minlength=len(texts))
                    np.add.at(weight, owner, gain[table.bucket][table.slot])
                parts.append((n_words, n_features, weight))
            if parts:
                sums = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *sums], [key, "n_words", "n_features", "weight"])

    rows = df.select(F.col(key), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(weigh, f"`{key}` {rows.schema[0].dataType.simpleString()}, n_words long, n_features long, weight long")


def ranked(df: DataFrame, order: list[Column], kept: Column, percent: int) -> DataFrame:
    """``df`` with ``rank`` 1, 2, … for the first per cent of the rows that ``kept`` admits.

    Ranges of the order are numbered side by side; a range's first number is the sum of the sizes before.
    """
    place = (F.when(kept, 0).otherwise(1).asc(), *order)
    at = unused_name(df, "at")
    # The id of a row is its partition's number, shifted, and its place in the sorted partition.
    rows = materialised(df.repartitionByRange(*place).sortWithinPartitions(*place).withColumn(at, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(at, 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.when(kept, 1)).alias("n"))
    every = Window.partitionBy(F.lit(0))
    sizes = sizes.select(
        F.col("part").alias(f"{at}_part"),
        F.coalesce(F.sum("n").over(every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{at}_before"),
        F.floor(F.sum("n").over(every) * percent / 100).alias(f"{at}_drawn"),
    )
    number = F.col(f"{at}_before") + F.col(at).bitwiseAND((1 << 33) - 1) + 1
    joined = rows.join(F.broadcast(sizes), part == F.col(f"{at}_part"))
    return joined.select(*df.columns, F.when(kept & (number <= F.col(f"{at}_drawn")), number).cast("long").alias("rank"))


def unused_name(df: DataFrame, name: str) -> str:
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    return name


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(key, n_features, weight, score, rank, n_words) of every row; drawn are the rows with a rank."""
    gain = gains(_counts(docs, text), _counts(target, target_text))
    # Dealing rows by ranges reads them twice, once for the bounds: a few numbers a row, not the texts.
    scored = materialised(weights(docs, gain, key, text).withColumn("score", F.col("weight") + noise(F.col(key))), "scores")
    drawn = ranked(scored, [F.desc("score"), F.asc_nulls_last(key)], F.col("n_words") >= LEAST_WORDS, PERCENT)
    return drawn.select(key, "n_features", "weight", "score", "rank", "n_words")
