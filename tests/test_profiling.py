import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from loanlens.operators import profiling
from loanlens.operators import quantiles as ranked
from loanlens.operators.quantiles import counted, exact_quantiles, quantiles, summary

RNG = np.random.default_rng(7)
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
SAMPLES = {
    "normal": RNG.normal(0, 1, 3001),
    "close together": 1e9 + RNG.uniform(0, 1e-3, 2000),
    "neighbours": np.array([np.nextafter(1.0, 2.0), 1.0, np.nextafter(np.nextafter(1.0, 2.0), 2.0)] * 5),
    "one hot value": np.concatenate([np.full(4000, 7.0), RNG.uniform(-5, 20, 1000)]),
    "wide": 10.0 ** RNG.uniform(-300, 300, 999) * RNG.choice([-1, 1], 999),
    "whole": RNG.integers(-50, 50, 1000).astype(float),
    "zeros": np.array([0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308]),
    "single": np.array([3.5]),
}


def test_quantiles_equal_a_full_sort(spark):
    data = [(name, float(v)) for name, values in SAMPLES.items() for v in values] + [("normal", None), ("normal", float("nan"))]
    got = exact_quantiles(spark.createDataFrame(data, "name string, value double"), PROBS)
    assert set(got) == set(SAMPLES)
    for name, values in SAMPLES.items():
        ordered = np.sort(values)
        place = np.array(PROBS) * (len(values) - 1)
        low, high = ordered[np.floor(place).astype(int)], ordered[np.ceil(place).astype(int)]
        assert got[name] == pytest.approx(list(low + (high - low) * (place - np.floor(place))), rel=1e-12), name


def test_counts_weigh_like_rows(spark):
    """Counted values give what their rows give, and huge counts cost nothing."""
    rows_ = [("a", float(v)) for v in RNG.integers(-20, 20, 2000)] + [("b", 1.5)] * 700 + [("c", None)]
    df = spark.createDataFrame(rows_, "name string, value double")
    plain = {r.name: r for r in summary(counted(df)).collect()}
    values = np.array([v for n, v in rows_ if n == "a"])
    a = plain["a"]
    assert (a["count"], a["min"], a["max"]) == (2000, values.min(), values.max())
    assert [a["mean"], a["std"], a.p25, a.p50, a.p75] == pytest.approx([values.mean(), values.std(ddof=1), *np.quantile(values, [0.25, 0.5, 0.75])])
    assert (plain["b"].p25, plain["b"]["std"], plain["b"]["count"]) == (1.5, 0.0, 700)
    assert (plain["c"]["count"], plain["c"]["mean"], plain["c"].p50) == (0, None, None)
    large = spark.createDataFrame([("x", 1.0, 10**12), ("x", 2.0, 10**12 - 1), ("x", 9.0, 3)], "name string, value double, n long")
    assert {r.prob: r.value for r in quantiles(large, [0.0, 0.5, 1.0]).collect()} == {0.0: 1.0, 0.5: 2.0, 1.0: 9.0}


def test_quantile_plan_sorts_ranges_only(spark):
    """The source is read once, before the plan; no window spans a name's rows."""
    df = spark.range(100_000).select(F.lit("v").alias("name"), (F.col("id") % 50_000).cast("double").alias("value"))
    plan = quantiles(counted(df), [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "parquet" in plan
    assert [r.value for r in quantiles(counted(df), [0.5]).collect()] == [24_999.5]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 1, 0.0), ("a", 2, -0.0), (None, 2, 1.5), ("b", None, None)], "t string, n int, d double")


def test_profile(table):
    got = rows(profiling.column_profile(table, "src").drop("sample"))
    assert got == [("src", "d", "double", 4, 1, 25.0, 2), ("src", "n", "int", 4, 1, 25.0, 2), ("src", "t", "string", 4, 1, 25.0, 2)]
    assert {r["column"]: r.sample for r in profiling.column_profile(table).collect()} == {"t": "a", "n": "1", "d": "0.0"}
    estimate = rows(profiling.column_profile(table, "src", exact=False).drop("sample"))
    assert estimate == got


def test_profile_by_group(table):
    got = rows(profiling.column_profile(table, "src", by="t").select("source", "column", "rows", "n_unique").filter("column = 'n'"))
    assert got == [("src", "n", 1, 1), ("src::a", "n", 2, 2), ("src::b", "n", 1, 0)]


def test_counts_and_vocabulary(table):
    assert [tuple(r) for r in profiling.value_counts(table, "t").collect()] == [("a", 2), ("b", 1), (None, 1)]
    assert [tuple(r) for r in profiling.vocabulary(table, ["t", "n"]).collect()] == [("n", "1", 1), ("n", "2", 2), ("t", "a", 2), ("t", "b", 1)]


def test_numeric_summary_with_nulls(spark, table):
    got = {r["column"]: r for r in profiling.numeric_summary(table, ["n", "d"]).collect()}
    assert (got["n"]["count"], got["n"].p25, got["n"].p50, got["n"].p75) == (3, 1.5, 2.0, 2.0)
    empty = spark.createDataFrame([], "n double")
    assert profiling.numeric_summary(empty, ["n"]).count() == 0


def test_quantile_windows_see_blocks_of_a_range(spark, monkeypatch):
    """A window took a whole range of values, which grows with the values a task gets."""
    monkeypatch.setattr(ranked, "BLOCK_BITS", 3)
    values = {"a": RNG.normal(0, 1, 500), "b": RNG.uniform(-9, 9, 333)}
    counts = counted(spark.createDataFrame([(n, float(v)) for n, held in values.items() for v in held], "name string, value double"))
    blocks = ranked.sorted_blocks(counts).groupBy("name", "block").agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    found = blocks.orderBy("name", "block").collect()
    assert max(r.rows for r in found) <= 8 and sum(r.rows for r in found) == 833
    assert all(x.name != y.name or x.high < y.low for x, y in zip(found, found[1:]))
    got = {(r.name, r.prob): r.value for r in quantiles(counts, PROBS).collect()}
    assert got == pytest.approx({(n, p): np.quantile(held, p) for n, held in values.items() for p in PROBS})


def test_numeric_summary_counts_by_number(spark, table, monkeypatch):
    """A name in every row was hashed, kept by every task and shuffled with each value."""
    written, kept = [], profiling.materialised
    monkeypatch.setattr(profiling, "materialised", lambda df, name: written.append(df) or kept(df, name))
    found = profiling.numeric_summary(table, ["n", "d"]).collect()
    assert [df.schema["name"].dataType.simpleString() for df in written] == ["int"]
    assert sorted((r["column"], r["count"], r.max) for r in found) == [("d", 3, 1.5), ("n", 3, 2.0)]


def test_year_histogram_has_every_year(spark):
    df = spark.createDataFrame([(f"{1950 + i}-03-01",) for i in range(25)] + [(None,)], "d string").withColumn("d", F.col("d").cast("date"))
    got = {r.year: tuple(r)[1:] for r in profiling.year_histogram(df, "d").collect()}
    assert set(got) == {*range(1950, 1975), None}
    assert got[1950] == (1, 1, 26, 1950, 1974) and got[1974] == (1, 25, 2, 1950, 1974) and got[None] == (1, 26, 1, 1950, 1974)


def test_raw_profile_derives_types_and_sees_drift(spark):
    data = [("1", "4", "1/2/2025", "x", "a"), ("1", "NA", None, "#N/A", "a"), ("2", "4.5", "00:00.0", "7", "b"), ("2", "5", "1/3/2025", None, "b")]
    df = spark.createDataFrame(data, "s string, n string, d string, t string, only string")
    held = spark.createDataFrame([(s, c) for s in "12" for c in "ndt"] + [("1", "only")], "s string, column string")
    got = {(r.source, r["column"]): (r.dtype, r.rows, r.n_null, r.n_unique) for r in profiling.raw_profile(df, by="s", held=held).collect()}
    assert got == {
        ("1", "n"): ("whole", 2, 1, 1), ("2", "n"): ("fraction", 2, 0, 2), ("1", "d"): ("date", 2, 1, 1), ("2", "d"): ("string", 2, 0, 2),
        ("1", "t"): ("string", 2, 1, 1), ("2", "t"): ("whole", 2, 1, 1), ("1", "only"): ("string", 2, 0, 1),
    }
    assert profiling.raw_profile(df.select(F.lit("NaN").alias("x"))).first().dtype == "empty"


def test_kinds_equal_the_plain_patterns(one):
    def plain(v):
        if v is None:
            return 0
        if re.search(r"^\s*[+-]?\d+\s*$", v, re.ASCII):
            return 1
        if re.search(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", v, re.ASCII):
            return 2
        return 4 if re.search(r"^\s*(\d{1,2}/\d{1,2}/\d{4}|\d{4}-\d{1,2}-\d{1,2}([T ].*)?)\s*$", v, re.ASCII) else 8

    texts = [None, "", " ", "0", "+5", "-5 ", "\t7", "5.", ".5", ".", "1e5", "1E-5", "1.5e+3", "e5", "1e", "+", "loan-1", ":", "9", "é", "~1"]
    texts += ["1/7/2025", "13/45/2020", " 2025-1-7T00:00", "2025-01-07 x", "2025-1", "00:00.0", "1 2", "NaN", "Infinity", "1d", "\u00a01", "\u0663"]
    assert one("t string", [(t,) for t in texts], lambda df: profiling.text_kind(df.t)) == [plain(t) for t in texts]


def test_columns_are_counted_by_number(spark):
    """A name in every row was hashed, kept and shuffled with each value."""
    counts = profiling.column_values(spark.createDataFrame([("x", "1"), (None, "1")], "a string, `b c` string"), by=["b c"])
    assert rows(counts) == [("1", "a", "x", 1), ("1", "a", None, 1)]
    counts = profiling.column_values(spark.createDataFrame([("x", "1"), (None, "1")], "a string, `b c` string"))
    assert rows(counts) == [("a", "x", 1), ("a", None, 1), ("b c", "1", 2)]
    grouped = counts._jdf.queryExecution().analyzed().children().head()
    assert grouped.schema().apply("column").dataType().simpleString() == "int"
