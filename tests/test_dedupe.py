from conftest import rows
from pyspark.sql import functions as F

from loanlens.operators import dedupe
from loanlens.operators.keys import coverage, key_presence, orphan_counts, orphan_keys, relationship_metrics
from loanlens.plans import staging


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_choice_does_not_depend_on_order_or_partitioning(spark):
    data = [(i % 7, (i * 31) % 5, None if i % 3 else i % 4, f"p{i % 6}") for i in range(300)]
    df = spark.createDataFrame(data, "k int, a int, b int, c string")
    first = rows(dedupe.first_per_key(df, ["k"], [F.col("a").desc_nulls_last()]))
    assert len(first) == 7
    for n in (1, 3, 11):
        shuffled = spark.createDataFrame(data[::-1], df.schema).repartition(n, "c")
        assert rows(dedupe.first_per_key(shuffled, ["k"], [F.col("a").desc_nulls_last()])) == first


def test_candidates_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedupe.first_per_key(df, ["k"]))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")


def dob_table(spark, records):
    return spark.createDataFrame(records, "`Loan Id ` string, provider string, date_of_birth string, `createdAt UTC` string")


def test_provider_rule(spark):
    got = staging.clean_dob(dob_table(spark, [
        ("r1", "SPINMOBILE", "1990-01-01 00:00:00", "2024-03-01T00:00:00.000Z"),
        ("r1", "TRANSUNION", "1991-01-01 00:00:00", "2020-01-01T00:00:00.000Z"),
        ("r1", "SMILEID", "1992-01-01 00:00:00", "2024-05-01T00:00:00.000Z"),
        ("r2", "SMILEID", "1980-01-01 00:00:00", "2024-01-01T00:00:00.000Z"),
        ("r2", "SMILEID", "1981-01-01 00:00:00", "2024-02-01T00:00:00.000Z"),
        ("r2", "SMILEID", "1982-01-01 00:00:00", None),
        ("r3", "OTHER", "1970-01-01T00:00:00+03:00", None),
        ("r3", None, "1960-01-01 00:00:00", None),
        ("#N/A", "TRANSUNION", "1970-01-01 00:00:00", None),
        (None, "TRANSUNION", "1970-01-01 00:00:00", None),
    ]))
    assert rows(got.select("loan_id", F.date_format("dob", "yyyy-MM-dd HH").alias("d"), "provider")) == [
        ("r1", "1991-01-01 00", "TRANSUNION"), ("r2", "1981-01-01 00", "SMILEID"), ("r3", "1960-01-01 00", None),
    ]


def test_longest_history(spark):
    df = spark.createDataFrame(
        [("a", "6", "100"), ("a", "12", "50"), ("a", "12", "70"), ("b", None, "5"), ("b", "1", None), ("c", None, None)],
        "`Loan Id` string, Duration string, Received string",
    )
    assert rows(staging.clean_income(df)) == [("a", 12.0, 70.0), ("b", 1.0, None), ("c", None, None)]


def test_customer_build(spark):
    sales = spark.createDataFrame(
        [("r1", "x", "12M"), ("r1", "x", "12M"), ("r2", "y", "6M"), ("r2", "z", "6M"), (None, "q", "1M"), (None, None, None), ("r3", " pad ", None)],
        "`Loan Id` string, `PRODUCT NAME` string, LOAN_TERM string",
    )
    gender = spark.createDataFrame([("r1", "KE", "F"), ("r1", "KE", "M"), ("#N/A", "KE", "M")], "`Loan Id` string, Citizenship string, Gender string")
    dob = dob_table(spark, [("r2", "SMILEID", "1980-01-01 00:00:00", None)])
    income = spark.createDataFrame([("r3", "2", "10")], "`Loan Id` string, Duration string, Received string")
    got = staging.clean_customer(sales, gender, dob, income)
    assert got.columns == ["loan_id", "product_name", "loan_term", "citizenship", "gender", "dob", "provider", "duration_months", "received_total"]
    assert rows(got.select("loan_id", "product_name", "gender", "provider", "duration_months")) == [
        ("r1", "x", "F", None, None), ("r2", "y", None, "SMILEID", None), ("r3", " pad ", None, None, 2.0),
    ]
    report = {r.metric: r.value for r in staging.sales_report(sales).collect()}
    assert report == {"rows_in": 6, "dropped_null_key": 1, "dropped_exact_copy": 1, "dropped_same_loan": 1, "rows_out": 3}
    assert [(r["column"], r.n_filled, r.filled_pct) for r in staging.customer_coverage(got).collect()] == [
        ("gender", 1, 33.3), ("dob", 1, 33.3), ("received_total", 1, 33.3)]


def test_attribute_joins_add_no_shuffle(spark):
    """Each side is already partitioned by loan when it has one row per loan."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = spark.range(50).select(F.col("id").cast("string").alias("loan_id"), "id")
        other = spark.range(50).select(F.col("id").cast("string").alias("loan_id"), (F.col("id") * 2).alias("x"))
        joined = staging.customer_spine(dedupe.first_per_key(sales, ["loan_id"]), dedupe.first_per_key(other, ["loan_id"]))
        assert plan(joined).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys(spark):
    a = spark.createDataFrame([("1",), ("1",), ("2",), (None,), (None,), ("#N/A",)], "k string")
    b = spark.createDataFrame([("2",), ("3",), (None,)], "k string")
    presence = key_presence(a=(a, "k"), b=(b, "k"))
    assert [tuple(r) for r in coverage(presence, [("a", "b"), ("b", "a")]).collect()] == [("a", "b", 3, 1, 33.33), ("b", "a", 2, 1, 50.0)]
    assert tuple(orphan_counts(presence, [("a", "b"), ("b", "a")]).first()) == (2, 1)
    assert rows(orphan_keys(a, "k", b, "k")) == [("#N/A",), ("1",)]
    metrics = {r.metric: r.value for r in relationship_metrics(presence, ["a"], [("a", "b")], ["a", "b"], ["a", "b"]).collect()}
    assert metrics == {"a_unique_keys": 3, "b_unique_keys": 2, "a_unresolved_keys": 1, "a_in_b_pct": 33.33, "a_duplicate_keys": 2, "b_duplicate_keys": 0}
    none = spark.createDataFrame([], "k string")
    assert coverage(key_presence(a=(none, "k"), b=(b, "k")), [("a", "b")]).first().coverage_pct == 0.0


def test_one_key_with_a_third_of_all_rows(spark):
    """Duplicates, coverage and the newest row stay right, and the hot key is cut down
    on the map side: each reducer gets at most one row of it per map task."""
    hot = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("loan_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("snapshot_date"),
        "id",
    )
    newest = {r.loan_id: r.id for r in dedupe.latest_state(hot).filter("loan_id = 'hot'").collect()}
    assert newest == {"hot": min(i for i in range(0, 30000, 3) if i % 300 == 297)}
    assert dedupe.latest_state(hot).count() == 20001
    presence = key_presence(a=(hot, "loan_id"), b=(hot.filter("id % 2 = 0"), "loan_id"))
    assert coverage(presence, [("a", "b")]).first().n_keys == 20001
    assert presence.filter("key = 'hot'").first().n_a == 10000
