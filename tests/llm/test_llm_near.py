"""Near copies at a five-word similarity, and nearest neighbours, against all pairs."""

import random

import brute
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loanlens.llm import ann_tree, components, simhash_wide
from loanlens.llm.text import prepared


def kept_ids(frame):
    return sorted(r.doc_id for r in simhash_wide.keep_first(frame).collect())


def test_one_of_each_near_group_stays(spark):
    docs = prepared(spark).createDataFrame(brute.DOCS, brute.SCHEMA)
    clashing = docs.withColumns({name: F.lit("x") for name in brute.CLASHING})
    root = brute.near_groups([t for _, t, *_ in brute.DOCS])
    expected = sorted(str(min((d[0] for d, r in zip(brute.DOCS, root) if r == k and d[0] is not None), default=None)) for k in set(root))
    for frame in (docs, clashing):
        kept = simhash_wide.keep_first(frame)
        assert kept.columns == frame.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == expected
    assert simhash_wide.keep_first(docs.limit(0)).count() == 0


def test_near_copies_go_and_others_stay(spark):
    """Texts with ever more words exchanged: at 0.8 and above at least nine in ten are found, below none."""
    draw = random.Random(3)
    rows, sets = [], {}
    for base in range(120):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.randrange(40, 400))]
        changed = list(words)
        for _ in range(draw.randrange(1, max(2, len(words) // 25))):
            changed[draw.randrange(len(words))] = f"x{draw.randrange(4000)}"
        for k, text in enumerate((" ".join(words), " ".join(changed).upper())):
            rows.append((2 * base + k, text, "en", "a", 1))
            sets[2 * base + k] = brute.shingles(text)
    kept = set(kept_ids(prepared(spark).createDataFrame(rows, brute.SCHEMA)))
    alike = {i for i in range(1, 240, 2) if brute.jaccard(sets[i], sets[i - 1]) >= 0.8}
    assert 20 < len(alike) < 110
    assert set(range(240)) - alike <= kept
    assert len(alike - kept) >= 0.9 * len(alike)


def test_a_large_group_of_near_copies_is_one(spark):
    draw = random.Random(4)
    words = [f"w{draw.randrange(4000)}" for _ in range(200)]
    rows = []
    for i in range(400):
        changed = list(words)
        changed[draw.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(changed), "en", "a", 1))
    rows.append((400, "something else altogether that nobody has copied", "en", "a", 1))
    assert kept_ids(prepared(spark).createDataFrame(rows, brute.SCHEMA)) == [0, 400]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    root = brute.near_groups([r.text for r in rows])
    expected = sorted(min(r.doc_id for r, k in zip(rows, root) if k == g) for g in set(root))
    assert kept_ids(docs) == expected


# Nearest neighbours -------------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, every, k=5):
    """Neighbours by all pairs: {query: [(id, score)]}."""
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            near = {(j, float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())))) for j, w in good if j != i and len(w) == len(v)}
            out[i] = sorted(near, key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(frame, every, k=5):
    out = {}
    for r in ann_tree.search(frame, F.col("vec_id") % every == 0, k=k).orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def agree(got, expected, least):
    assert {q for q, near in expected.items() if near} == got.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in expected.items() if near)
    assert hits >= least * sum(map(len, expected.values()))
    for q, near in got.items():
        assert len(near) == len(expected[q]) and [s for _, s in near] == sorted((s for _, s in near), reverse=True)


def test_neighbours_of_the_given_vectors(spark):
    table = prepared(spark).read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got, expected = found(table, 50), exact(rows, 50)
    agree(got, expected, 0.9)
    for q, near in got.items():
        true = dict(exact([(q, dict(rows)[q]), *[(i, dict(rows)[i]) for i, _ in near]], q or 10**9)[q])
        assert all(abs(true[i] - s) < 1e-12 for i, s in near)


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (6, [0.0, 0.0, 0.0]),
            (8, [1.0, None, 0.0]), (10, [nan, 1.0, 0.0]), (12, [inf, 1.0, 0.0]), (14, [1.0, 1.0]), (15, [1.0, 0.0]), (16, []),
            (18, [-1.0, 0.0, 0.0]), (18, [-1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (20, [1.0])]
    frame = prepared(spark).createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumns({n: F.lit("x") for n in ("class", "a", "rank", "leaf", "ids")})
    expected = {q: near for q, near in exact(rows, 2).items() if near}
    assert found(frame, 2) == expected
    assert [i for i, _ in expected[0]] == [1, 2, 3, 18]
    assert ann_tree.search(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert ann_tree.search(frame, F.col("vec_id") == 77).count() == 0


def test_many_copies_of_a_vector(spark, monkeypatch):
    """A third of the rows is one vector; blocks and leaves are small, so that all of them are cut."""
    monkeypatch.setattr(ann_tree, "BLOCK", 20)
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist() if i % 3 else [1.0] * 8) for i in range(900)]
    frame = prepared(spark).createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got, expected = found(frame, 10), exact(rows, 10)
    agree(got, expected, 0.9)
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15] and [i for i, _ in got[30]] == [0, 3, 6, 9, 12]
    assert found(frame.repartition(7), 10) == got


def test_tree_visits_every_leaf_once():
    draw = np.random.default_rng(2)
    units = ann_tree.units(list(draw.normal(size=(500, 6))), 6)
    tree = ann_tree.fit(units, 32)
    for unit in units[:20]:
        order = list(tree.visits(unit))
        assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 10
    assert ann_tree.fit(ann_tree.units([np.ones(3)] * 200, 3), 32).leaves == 1


def test_large_buckets_lose_no_pair(spark):
    """Families of texts around a similarity of 0.8, their ids mixed: a bucket's size changes nothing."""
    draw = np.random.default_rng(5)
    rows = []
    for family in range(3):
        base = [f"w{family}x{i}" for i in range(150)]
        for _ in range(40):
            words = list(base)
            for at in draw.choice(150, draw.integers(1, 6), replace=False):
                words[at] = f"v{draw.integers(1 << 30)}"
            rows.append(" ".join(words))
    order = draw.permutation(len(rows))
    frame = prepared(spark).createDataFrame([(int(i), rows[at]) for i, at in enumerate(order)], "doc_id long, text string")

    def ids(bucket):
        return sorted(r.doc_id for r in simhash_wide.keep_first(frame, bucket=bucket).collect())

    whole = ids(10**6)
    assert len(whole) < len(rows)
    assert ids(2) == whole


def test_texts_about_a_large_group_do_not_meet_all_of_it(spark, monkeypatch):
    """Texts that share much with every text of a group, but too little: none is named, and none is lost."""
    draw = np.random.default_rng(8)
    base = [f"w{i}" for i in range(170)]

    def changed(n):
        words = list(base)
        for at in draw.choice(170, n, replace=False):
            words[at] = f"v{draw.integers(1 << 30)}"
        return " ".join(words)

    rows = [changed(2) for _ in range(60)] + [changed(7) for _ in range(20)]
    frame = prepared(spark).createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    whole = sorted(r.doc_id for r in simhash_wide.keep_first(frame, bucket=10**6).collect())
    written, write = {}, simhash_wide.materialised
    monkeypatch.setattr(simhash_wide, "materialised", lambda df, name: written.setdefault(name, write(df, name)))
    assert sorted(r.doc_id for r in simhash_wide.keep_first(frame, bucket=2).collect()) == whole
    assert len(whole) > 15
    assert written["wide-rest"].count() < 60


def test_tables_that_grow_are_not_broadcast(spark, monkeypatch):
    """Exploded keys and arrays of keys look small to Spark; under its own threshold they meet sorted all the same."""
    draw = np.random.default_rng(9)
    base = [f"w{i}" for i in range(170)]

    def changed(n):
        words = list(base)
        for at in draw.choice(170, n, replace=False):
            words[at] = f"v{draw.integers(1 << 30)}"
        return " ".join(words)

    rows = [changed(2) for _ in range(40)] + [changed(7) for _ in range(10)]
    frame = prepared(spark).createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    plans = {}

    def noted(write):
        def kept(df, name):
            plans[f"{name} {len(plans)}"] = df._jdf.queryExecution().executedPlan().toString()
            return write(df, name)

        return kept

    monkeypatch.setattr(simhash_wide, "materialised", noted(simhash_wide.materialised))
    # The rounds over links are left to Spark, which has their sizes from written tables.
    links, write = noted(components.materialised), components.materialised
    monkeypatch.setattr(components, "materialised", lambda df, name: (links if name == "links" else write)(df, name))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) == 10 << 20
    plans["kept"] = simhash_wide.keep_first(frame, bucket=2)._jdf.queryExecution().executedPlan().toString()
    assert {"links", "wide-pairs", "wide-large", "wide-early", "wide-rest", "wide-joined", "kept"} <= {name.split()[0] for name in plans}
    assert [name for name, plan in plans.items() if "BroadcastExchange" in plan] == []
