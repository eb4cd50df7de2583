"""Resampling and source divergence against plain Python, on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from loanlens.llm import ngram_resampling, source_divergence
from loanlens.llm.text import prepared

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
MADE = [(100 + i, " ".join(random.Random(i).choices(["Ab", "ab", "cd'ef", "Ünd", "x1", "zz-top", "straße"], k=i % 60)), "en", "abc"[i % 3], 1) for i in range(120)]
ROWS = [*brute.DOCS, *MADE]


@pytest.fixture(scope="module")
def docs(spark):
    return prepared(spark).createDataFrame(ROWS, brute.SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.withColumns({name: F.lit("x") for name in [*brute.CLASHING, "weight", "rank", "at", "n_features", "digest", "places", "term", "part", "item", "n"]})


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)], len(w)


def resampled(rows, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    held = [(key, *features(text)) for key, text, *_ in rows]
    s, t = Counter(bucket(f) for _, fs, _ in held for f in fs), Counter(bucket(f) for x in target for f in features(x)[0])
    whole, aim = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (whole + 10_000) / ((s[b] + 1) * (aim + 10_000))))
    out = []
    for key, fs, n in held:
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: 5 * len(able) // 100], 1):
        r[4] = i
    return sorted(map(str, map(tuple, out)))


def test_resampling_equals_the_plain_version(spark, docs, clashing, monkeypatch):
    target = ["ab cd ef straße", None, "", "x1 x1 x1 zz"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    expected = resampled(ROWS, target)
    assert sum("None" not in r.split(", ")[4] for r in expected) >= 2
    for frame in (docs, clashing, docs.repartition(9)):
        assert sorted(map(str, map(tuple, ngram_resampling.resample(frame, bench).collect()))) == expected
    none = ngram_resampling.resample(docs, bench.limit(0)).collect()
    assert sorted(map(str, map(tuple, none))) == resampled(ROWS, [])
    assert ngram_resampling.resample(docs.limit(0), bench).count() == 0


def test_resampling_reads_the_texts_twice(spark, docs):
    """Once to count their features, once to weigh them: dealing the scores by ranges weighs no text again."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    watched = docs.repartition(3).select("doc_id", seen.asNondeterministic()("text").alias("text"))
    ngram_resampling.resample(watched, spark.createDataFrame([(1, "ab cd")], "item_id long, text string")).collect()
    assert read.value == 2 * len(ROWS)


def test_hashes_equal_the_libraries():
    words = ngram_resampling.Words([" ".join("ab" * k + "é" * (k % 7) for k in range(140)).encode(), b"", b"One two--THREE"])
    for start, size, _ in words.features():
        keys = words.hashed(start, size, ngram_resampling._xxh64, xxhash.xxh64_intdigest)
        sums = words.hashed(start, size, ngram_resampling._crc32, zlib.crc32)
        pieces = [words.buffer[a : a + n] for a, n in zip(start, size)]
        assert keys.tolist() == [xxhash.xxh64_intdigest(p) for p in pieces] and sums.tolist() == [zlib.crc32(p) for p in pieces]


def test_equal_hashes_do_not_mix_features(monkeypatch):
    """With one hash for all, the bytes alone tell features apart."""
    monkeypatch.setattr(ngram_resampling.Words, "hashed", lambda self, start, size, short, long: np.zeros(len(start), dtype=np.uint64))
    words = ngram_resampling.Words([b"aa ab aa ac abcdefghij abcdefghik aa abcdefghij", b"ab aa"])
    for start, size, _ in words.features():
        table = ngram_resampling.Table(words, start, size)
        pieces = [words.buffer[a : a + n] for a, n in zip(start, size)]
        assert len(set(table.slot.tolist())) == len(set(pieces)) == len(table.used)
        assert [int(table.count[s]) for s in table.slot] == [pieces.count(p) for p in pieces]


@pytest.mark.parametrize("spans", [1 << 18, 7])
def test_long_texts_pass_in_parts(monkeypatch, spans):
    monkeypatch.setattr(ngram_resampling, "SPANS", spans)
    text = b"one Two three  four two three\x00" * 20
    words = ngram_resampling.Words([text, b"last"])
    got = Counter(words.buffer[a : a + n].decode() for start, size, _ in words.features() for a, n in zip(start, size))
    assert got == Counter(features(text.decode())[0] + ["last"])


def divergence(rows):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for _, text, lang, source, *_ in rows]
    out = []
    differ = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {d[0] for d in docs}:
        df = Counter(t for x, _, c in docs if x == lang for t in c)
        kept = sorted((t for t in df if df[t] >= 10), key=lambda t: t.encode())
        count = {s: sum((c for x, y, c in docs if (x, y) == (lang, s)), Counter()) for s in {d[1] for d in docs if d[0] == lang}}
        total = lambda c: sum(c[t] for t in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (total(c) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(sum(count.values(), Counter()))
        for s in count:
            parts = {"pair": [(sum(differ(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s],
                     "term": [(differ(p[s][t], q[t]), t) for t in kept if count[s][t] > 0 and p[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= 10]
    return sorted(out)


def test_counts_passed_on_early_add_up(monkeypatch):
    rows = [("en", text or "", [{"source": s, "copies": i + 1} for s in "ab"[: 1 + i % 2]]) for i, (_, text, *_) in enumerate(MADE)]
    places = pa.list_(pa.struct([("source", pa.string()), ("copies", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), places))], ["lang", "text", "places"])

    def counted():
        out = Counter()
        for part in source_divergence._count([batch]):
            for r in part.to_pylist():
                for p in r["places"]:
                    out[r["lang"], r["term"], p["source"], "docs"] += p["docs"]
                    out[r["lang"], r["term"], p["source"], "n"] += p["n"]
        return out

    whole = counted()
    monkeypatch.setattr(source_divergence, "HELD", 3)
    assert counted() == whole and len(whole) > 10


def test_divergence_equals_the_plain_version(spark, docs, clashing):
    expected = divergence(ROWS)
    assert {r[2] for r in expected} == {"pair", "term"}
    for frame in (docs, clashing):
        got = source_divergence.divergence(frame)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == expected
    assert source_divergence.divergence(docs.limit(0)).count() == 0


def test_copies_count_as_often_as_they_stand(spark):
    """A third of the rows is one text; sources share copies."""
    rows = [(i, "alpha beta alpha" if i % 3 == 0 else f"gamma w{i % 11} beta", "en", "abc"[i % 2], 1) for i in range(90)]
    assert sorted(map(tuple, source_divergence.divergence(prepared(spark).createDataFrame(rows, brute.SCHEMA)).collect())) == divergence(rows)
    collapsed = source_divergence.collapsed(prepared(spark).createDataFrame(rows, brute.SCHEMA)).collect()
    assert sum(p.copies for r in collapsed for p in r.places) == 90 and len(collapsed) == len({r[1] for r in rows})


def test_shares_of_huge_counts_are_exact(spark):
    n, total, kept = 10**13 + 7, 3 * 10**14 + 11, 1000
    got = spark.createDataFrame([(n, total, kept)], "n long, total long, v long").select(source_divergence.share("n", "total", "v")).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_terms_of_every_byte():
    """Terms are cut by one table of bytes; every single byte and odd characters agree with the pattern."""
    texts = ["".join(f"aB{chr(c)}Cd" for c in range(128)), "\x1cA\x1f\x85b\xa0 Ä İ ß@[`{", "", " .", "é"]
    for text in texts:
        assert source_divergence.terms_of(text.encode()) == [t.encode() for t in TERM.findall(text.translate(LOWER))]
