"""The registered queries against their SQL, and the pipeline against a plain version."""

import collections
import math
import re

import brute
import corpus_pipeline
import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as register
from loanlens.llm import decontamination, queries, quality_rules

TABLES = "documents pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return connection


def shown(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in row)


def test_all_of_them_and_the_pipeline_are_registered():
    names = [n for n in register.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(register.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(shown, df.select(columns).collect())) == sorted(map(shown, result.fetchall()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plans_have_no_cross_join(spark, name):
    text = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    if name in ("op1_quality_rules", "op3_sharding", "op6_mixing", "op10_secrets"):
        assert not re.search("Python|Pandas|Arrow", text)


def plain_pipeline(docs, labels, items):
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in docs if not brute.base(r.text)[-1]]
    assert collections.Counter(labels.values())[1] < 480, "with more labels cutoffs would count too"
    root = brute.near_groups([t for _, t, _, _ in rows])
    first = {}
    for (i, *_), r in zip(rows, root):
        first[r] = min(i, first.get(r, i))
    rows = [x for x, r in zip(rows, root) if first[r] == x[0]]
    rows = [x for x in rows if not any(brute.five_word_share(x[1], item) >= decontamination.OVERLAP for item in items)]
    copies, *_ = brute.mix([(i, s, len(brute.words(t))) for i, t, s, _ in rows])
    owner = brute.maglev(queries.SHARDS, queries.SLOTS)
    return sorted((i, t, owner[brute.md5_point(i, 15) % queries.SLOTS]) for (i, t, *_), n in zip(rows, copies) for _ in range(n))


def test_pipeline_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    expected = plain_pipeline(docs.collect(), labels, items)
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == [*docs.columns, "shard"]
    assert sorted((r.doc_id, r.text, r.shard) for r in got.collect()) == expected
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.text, r.shard) for r in again.collect()) == expected


def test_stages_stand_odd_rows(spark):
    frame = spark.createDataFrame(brute.DOCS, brute.SCHEMA).withColumn("shard", F.lit("x"))
    for start in (frame, frame.limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            assert docs.columns[: len(start.columns)] == start.columns
            docs.collect()


def test_good_documents_of_the_given_table_stay(spark):
    rated = quality_rules.rate(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert all(r.kept for r in rated.collect() if not r.base_failed)
