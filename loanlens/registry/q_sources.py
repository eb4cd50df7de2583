"""Reading raw files and writing tables; the files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.plans import staging
from loanlens.registry import adapters as a
from loanlens.registry.adapters import sql_day, sql_round, using, write_snapshot_files
from loanlens.registry.core import query, table
from loanlens.registry.q_cleaning import CLEAN_ROWS, CUSTOMER, REASON, SURVEY_LOAN, SURVEY_SCORE
from loanlens.schemas import CUSTOMER_TABLES
from loanlens.session import materialised, shared_dir
from loanlens.sources import headers, snapshots, tables
from loanlens.streaming import events
from loanlens.streaming.snapshots import stage_arriving_snapshots
from loanlens.operators.cleaning import normalise_nulls


def read_back(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read_snapshot_files(spark, f"{root}/*{snapshots.FILE_GLOB}", drop_blank=True, required=("LOAN_ID",))


@query("src_snapshot_csv", using("clean") + CLEAN_ROWS)
def src_snapshot_csv(spark, sf):
    root = shared_dir(spark, "snapshot-csv")
    a.write_credit_files(spark, sf, root)
    return staging.clean_credit_snapshot(read_back(spark, root))


# The join below the raw rows ends in small tasks, each of which would leave a file for every snapshot;
# a micro-batch has its price whatever its files hold.
LINES_PER_TASK = 1_000_000


@query("stream_snapshot_csv", using("clean") + CLEAN_ROWS)
def stream_snapshot_csv(spark, sf):
    """The staged table that the arriving files give, a few files per micro-batch."""
    root, staged = shared_dir(spark, "arriving-csv"), shared_dir(spark, "arriving-staged")
    tasks = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf, "lineitem").count() // LINES_PER_TASK))
    a.write_snapshot_files(a.raw_credit(spark, sf).coalesce(tasks), root)
    done = stage_arriving_snapshots(spark, root, staged, shared_dir(spark, "arriving-log"), files_per_batch=4)
    done.awaitTermination()
    return spark.read.parquet(staged).drop("batch")


# Every fiftieth event comes after all others; weeks that these have closed by then take none of them.
ARRIVALS = """WITH e AS (
  SELECT *, event_id % 50 = 0 AS second, CAST(date_trunc('week', ts) AS DATE) AS period,
    CAST(date_trunc('week', ts) AS DATE) + INTERVAL 7 DAY AS period_end FROM events),
w AS (SELECT max(ts) FILTER (NOT second) - INTERVAL 2 DAY AS first_mark, max(ts) - INTERVAL 2 DAY AS last_mark FROM e),
kept AS (SELECT e.* FROM e, w WHERE period_end <= last_mark AND NOT (second AND period_end <= first_mark))
"""


def arrived(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Snapshots and rejects of events that arrive in two parts, the stream ended and started again between."""
    root = shared_dir(spark, "event-stream")
    paths = [f"{root}/{name}" for name in ("arriving", "snapshots", "rejects", "log")]
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    second = F.col("event_id") % 50 == 0
    for part in (~second, second):
        rows.filter(part).write.mode("append").parquet(paths[0])
        events.keep_snapshots(spark, *paths, delay="2 days", unit="week").awaitTermination()
    return paths[1], paths[2]


@query("stream_event_snapshots", ARRIVALS + f"""
SELECT user_id, {sql_day('period')} AS period, count(*) AS n, {sql_round('sum(value)', 4)} AS total,
  strftime(date_trunc('second', max(ts)), '%Y-%m-%d %H:%M:%S') AS last_event, arg_max(event_type, (ts, event_id)) AS last_type
FROM kept GROUP BY user_id, period""")
def stream_event_snapshots(spark, sf):
    kept, _ = arrived(spark, sf)
    return spark.read.schema(events.SNAPSHOTS).parquet(kept).withColumn("total", F.round("total", 4))


@query("stream_event_rejects", ARRIVALS + f"""
SELECT event_id, user_id, {sql_day('period')} AS period, event_type, value FROM e, w WHERE second AND period_end <= first_mark""")
def stream_event_rejects(spark, sf):
    _, rejects = arrived(spark, sf)
    return spark.read.schema(events.REJECTS).parquet(rejects).drop("ts", "batch")


@query("src_filename_date", using("ls") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS n FROM ls GROUP BY snapshot_date""")
def src_filename_date(spark, sf):
    root = shared_dir(spark, "snapshot-names")
    write_snapshot_files(a.raw_credit(spark, sf).select("LOAN_ID", "BALANCE", "snapshot_date"), root)
    return read_back(spark, root).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@query("union_drifted_snapshots", using("raw") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS n, count(CASE WHEN year(snapshot_date) >= 1998 THEN 1 END) AS n_deposit,
  {sql_round('sum(l_quantity)', 2)} AS payment, {sql_round('sum(l_extendedprice)', 2)} AS balance FROM raw GROUP BY snapshot_date""")
def union_drifted_snapshots(spark, sf):
    """Earlier files lack a column and hold whole numbers; later ones have another column
    order and a column without header in the middle."""
    root = shared_dir(spark, "snapshot-drift")
    raw = a.raw_credit(spark, sf).select("LOAN_ID", "PAYMENT", "BALANCE", "DEPOSIT", "snapshot_date")
    later = F.year("snapshot_date") >= 1998
    whole = F.col("PAYMENT").cast("double").cast("bigint").cast("string").alias("PAYMENT")
    write_snapshot_files(raw.filter(~later).select("LOAN_ID", whole, "BALANCE", "snapshot_date"), root)
    blank = F.lit(None).cast("string").alias("Unnamed: 2")
    write_snapshot_files(raw.filter(later).select("DEPOSIT", "BALANCE", blank, "PAYMENT", "LOAN_ID", "snapshot_date"), root)
    staged = staging.stage_credit_columns(read_back(spark, root))
    return staged.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("deposit").alias("n_deposit"),
        F.round(F.sum("payment"), 2).alias("payment"),
        F.round(F.sum("balance"), 2).alias("balance"),
    )


@query("src_customer_tables", CUSTOMER + """
SELECT * REPLACE (strftime(dob, '%Y-%m-%d %H:%M:%S') AS dob) FROM customer_built""")
def src_customer_tables(spark, sf):
    root = shared_dir(spark, "customer-csv")
    for name, rows in a.raw_customer_tables(spark, sf).items():
        rows.write.option("header", True).option("escape", '"').csv(f"{root}/{CUSTOMER_TABLES[name]}")
    return staging.clean_customer(**tables.read_customer_tables(spark, root))


@query("src_survey", f"""
SELECT CAST(event_id AS VARCHAR) AS submission_id, {SURVEY_LOAN} AS loan_id, {SURVEY_SCORE} AS nps_score,
  {REASON} AS reason FROM events WHERE {SURVEY_LOAN} IS NOT NULL AND {SURVEY_SCORE} IS NOT NULL""")
def src_survey(spark, sf):
    path = shared_dir(spark, "survey-csv")
    a.raw_survey(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    cleaned = staging.clean_survey(tables.read_survey(spark, path))
    return cleaned.select("submission_id", "loan_id", "nps_score", F.col(f"`{a.REASON_HEADER}`").alias("reason"))


@query("src_null_tokens", using("raw") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(CASE WHEN l_quantity NOT IN (49, 50) THEN 1 END) AS loan_id,
  count(CASE WHEN l_quantity <> 44 THEN 1 END) AS total_due_today, count(CASE WHEN l_returnflag <> 'A' THEN 1 END) AS payment_amount,
  CAST(0 AS BIGINT) AS adjustment_amount FROM raw GROUP BY snapshot_date""")
def src_null_tokens(spark, sf):
    named = normalise_nulls(a.raw_credit(spark, sf))
    return named.groupBy("snapshot_date").agg(
        *[F.count(c).alias(c.lower()) for c in ("LOAN_ID", "TOTAL_DUE_TODAY", "PAYMENT_AMOUNT", "ADJUSTMENT_AMOUNT")]
    )


@query("src_header_norm", """
SELECT CASE WHEN l_quantity <> 50 THEN 'loan-' || l_orderkey END AS loan_id, l_returnflag AS sale_type,
  l_linestatus AS seller_type FROM lineitem""")
def src_header_norm(spark, sf):
    sales = a.raw_customer_tables(spark, sf)["sales"].withColumnRenamed("Loan Id", " Loan Id ")
    return headers.snake_headers(headers.strip_headers(sales))


@query("sink_partition_overwrite", using("ls") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS n,
  {sql_round('sum(CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM ls) THEN 2 * balance ELSE balance END)', 2)} AS balance
FROM ls GROUP BY snapshot_date""")
def sink_partition_overwrite(spark, sf):
    """Write all partitions, then only the newest again with other values: the rest stays."""
    path = shared_dir(spark, "partitions")
    rows = a.loan_snapshot(spark, sf)
    tables.write_partitions(rows, path)
    written = spark.read.parquet(path)
    newest = materialised(written.filter(F.col("snapshot_date") == written.agg(F.max("snapshot_date")).scalar()), "newest")
    for _ in range(2):
        tables.write_partitions(newest.withColumn("balance", F.col("balance") * 2), path)
    return spark.read.parquet(path).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance")
    )


@query("sink_parquet_roundtrip", "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders")
def sink_parquet_roundtrip(spark, sf):
    path = shared_dir(spark, "flat")
    for _ in range(2):
        tables.write_table(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@query("sink_csv_roundtrip", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def sink_csv_roundtrip(spark, sf):
    path = shared_dir(spark, "report")
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    tables.write_result(counts, path)
    return spark.read.schema("o_orderpriority string, n bigint").option("header", True).csv(path)


@query("src_partitioned_view", using("ls") + f"""
SELECT {sql_day('snapshot_date')} AS snapshot_date, count(*) AS n, {sql_round('sum(balance)', 2)} AS balance
FROM ls GROUP BY snapshot_date""")
def src_partitioned_view(spark, sf):
    path = shared_dir(spark, "view")
    tables.write_partitions(a.loan_snapshot(spark, sf), path)
    tables.register_views(spark, fct_credit=path)
    return spark.sql(
        "SELECT snapshot_date, count(*) AS n, round(sum(balance), 2) AS balance FROM fct_credit GROUP BY snapshot_date"
    )
