import datetime as dt

from conftest import SMALL, rows
from pyspark.sql import functions as F

from loanlens.streaming import events


def event(i, day, user, value=1.0, kind="view", month=1):
    return (i, dt.datetime(2024, month, day, 12), user, kind, value)


def run(spark, root, *batches, **options):
    paths = [f"{root}/{name}" for name in ("in", "snapshots", "rejects", "log")]
    for batch in batches:
        spark.createDataFrame(batch, events.EVENTS).coalesce(1).write.mode("append").parquet(paths[0])
        events.keep_snapshots(spark, *paths, **options).awaitTermination()
    return spark.read.schema(events.SNAPSHOTS).parquet(paths[1]), spark.read.schema(events.REJECTS).parquet(paths[2])


def test_periods_close_late_rows_are_kept_apart_and_a_restart_goes_on(spark, tmp_path):
    first = [event(1, 1, 7, 2.0), event(2, 2, 7, 3.0, "buy"), event(3, 2, 8), event(4, 9, 7), event(5, 9, None)]
    # The week from the 1st ends on the 8th; the 9th less a day is past it.
    done, rejected = run(spark, tmp_path, first, delay="1 day", unit="week")
    week = dt.date(2024, 1, 1)
    assert rows(done.select("user_id", "period", "n", "total", "last_type")) == [(7, week, 2, 5.0, "buy"), (8, week, 1, 1.0, "view")]
    assert rejected.count() == 0
    # A new start: one row too late, one for the open week, one that closes it.
    done, rejected = run(spark, tmp_path, [event(6, 3, 7, 9.0), event(7, 10, 7, 4.0), event(17, 20, 8)], delay="1 day", unit="week")
    assert rows(rejected.select("event_id", "user_id", "period", "event_type", "value")) == [(6, 7, week, "view", 9.0)]
    assert rows(done.filter("period <> '2024-01-01'").select("user_id", "period", "n", "total")) == [(7, dt.date(2024, 1, 8), 2, 5.0)]
    assert done.filter("period = '2024-01-01'").count() == 2


def test_a_stream_gives_what_a_batch_gives(spark, tmp_path):
    """All events of the given table, and one far ahead that closes every week."""
    table = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    # One user has most of the events.
    table = table.withColumn("user_id", F.when(F.col("event_id") % 3 > 0, 1).otherwise(F.col("user_id")).cast("long"))
    ahead = spark.createDataFrame([(-1, dt.datetime(2030, 1, 1), -1, "end", 0.0)], events.EVENTS)
    paths = [f"{tmp_path}/{name}" for name in ("in", "snapshots", "rejects", "log")]
    for part in (table, ahead):
        part.write.mode("append").parquet(paths[0])
        events.keep_snapshots(spark, *paths, delay="2 days", unit="week").awaitTermination()
    shown = ["user_id", "period", "n", F.round("total", 6).alias("total"), "last_event", "last_type"]
    got = spark.read.schema(events.SNAPSHOTS).parquet(paths[1]).select(*shown)
    assert rows(got) == rows(events.by_period(table, "week").select(*shown))
    assert spark.read.schema(events.REJECTS).parquet(paths[2]).count() == 0


def test_a_repeated_batch_writes_the_same_and_no_task_keeps_users(spark, tmp_path):
    paths = [f"{tmp_path}/{name}" for name in ("in", "snapshots", "rejects", "log")]
    first = [event(1, 1, 7), event(2, 2, 7, None, "buy"), event(3, 9, 7), event(4, 1, 8, None)]
    second = [event(5, 3, 7), event(6, 10, 7), event(7, 20, 8)]

    def kept():
        return rows(spark.read.schema(events.SNAPSHOTS).parquet(paths[1])), rows(spark.read.schema(events.REJECTS).parquet(paths[2]))

    for batch in (first, second):
        spark.createDataFrame(batch, events.EVENTS).coalesce(1).write.mode("append").parquet(paths[0])
        seen = []
        for again in (False, True):
            query = events.keep_snapshots(spark, *paths, delay="1 day", unit="week")
            query.awaitTermination()
            assert all(not p.stateOperators for p in query.recentProgress)
            seen.append(kept())
            # The batch failed after all its tables were written: it comes again.
            newest = max((tmp_path / "log" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
            if not again:
                newest.unlink()
                (newest.parent / f".{newest.name}.crc").unlink()
        assert seen[0] == seen[1]
    done = seen[1]
    # A user whose events carry no value has no total.
    assert [r[:3] for r in done[0]] == [(7, 2, 1.0), (7, 2, 2.0), (8, 1, None)]
    assert [r[0] for r in done[1]] == [5]
