"""Snapshots of users by month, week or day, kept up to date from a stream of events.

Each user's open periods are rows of a table beside the checkpoint: a micro-batch adds one row
per user and period that its events touch.  The watermark, the newest time seen less the
delay, closes a period, whose rows are then put together and written; a row that comes for a
closed period goes to a table of rejects instead of being lost.  An event is read in its own
batch and its period's row once more when the period closes.

All of it is grouping, combined before the shuffle, so a user with a third of all events is
one row per task.  What a batch writes lies under its number, and rows of closed periods go
only when the next batch has begun, so a batch that is repeated after a failure writes the
same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanlens.session import remove
from loanlens.sources.tables import write_partitions

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"
SNAPSHOTS = "user_id long, n long, total double, last_event timestamp, last_type string, period date"
REJECTS = "event_id long, user_id long, period date, ts timestamp, event_type string, value double, batch long"
OPEN = "user_id long, period long, n long, total double, last long, last_id long, last_type string, end long, batch long"


def _dated(events: DataFrame, unit: str) -> DataFrame:
    """Events with their time, period and the period's end in milliseconds."""
    begin = F.date_trunc(unit, "ts")
    end = F.add_months(begin.cast("date"), 1) if unit == "month" else F.date_add(begin.cast("date"), {"week": 7, "day": 1}[unit])
    return events.select(
        "event_id", "user_id", "event_type", "value", F.unix_millis("ts").alias("at"),
        F.unix_millis(begin).alias("period"), F.unix_millis(end.cast("timestamp")).alias("end"),
    )


def _as_state(dated: DataFrame) -> DataFrame:
    """Every event as a row that ``totals`` can put together."""
    return dated.select("user_id", "period", "end", F.lit(1).alias("n"), F.col("value").alias("total"), F.col("at").alias("last"),
                        F.col("event_id").alias("last_id"), F.col("event_type").alias("last_type"))


def partial_sums(dated: DataFrame) -> DataFrame:
    """One row per user and period, in the form of ``OPEN`` but for the batch."""
    latest = F.max(F.struct("last", "last_id", "last_type"))
    sums = _as_state(dated).groupBy("user_id", "period", "end").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), latest.alias("latest"))
    return sums.select("user_id", "period", "n", "total", "latest.*", "end")


def totals(rows: DataFrame) -> DataFrame:
    """(user_id, period, n, total, last_event, last_type) of the slots' sums."""
    latest = F.max_by(F.struct("last", "last_type"), F.struct("last", "last_id"))
    sums = rows.groupBy("user_id", "period").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), latest.alias("latest"))
    return sums.select(
        "user_id", F.timestamp_millis("period").cast("date").alias("period"), "n", "total",
        F.timestamp_millis("latest.last").alias("last_event"), F.col("latest.last_type").alias("last_type"),
    )


def keep_snapshots(
    spark: SparkSession, folder: str, table: str, rejects: str, checkpoint: str, delay: str = "10 days", unit: str = "month", **trigger
) -> StreamingQuery:
    """Start keeping snapshots of the event files in a folder; by default it ends once everything present is in.

    A period is written when the newest event is ``delay`` past its end; until then it is state.
    Rows without user or time belong to no period and are left out.  The open periods and the
    watermark are kept in the checkpoint's folder.
    """
    events = spark.readStream.schema(EVENTS).parquet(folder).dropna(subset=["user_id", "ts"])
    held = f"{checkpoint}/open-periods"

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # The mark of the batch before; the one before that is no longer needed.
        mark = session.read.schema("mark long").parquet(f"{checkpoint}/marks/{(number - 1) % 2}").first().mark if number else None
        if mark is not None:
            remove(session, held, lambda name: int(name.removeprefix("end=")) <= mark)
        dated = _dated(batch, unit)
        is_late = F.col("end") <= mark if mark is not None else F.lit(False)
        late = dated.filter(is_late).select("event_id", "user_id", F.timestamp_millis("period").cast("date").alias("period"),
                                            F.timestamp_millis("at").alias("ts"), "event_type", "value",
                                            F.lit(number).cast("long").alias("batch"))
        write_partitions(late, rejects, "batch")
        on_time = partial_sums(dated.filter(~is_late)).withColumn("batch", F.lit(number).cast("long"))
        write_partitions(on_time, held, "end", "batch")

        rows = session.read.schema(OPEN).parquet(held)
        # A late row cannot move the mark, so the rows just written tell the newest time.
        newest = F.unix_millis(F.timestamp_millis(F.max("last")) - F.expr(f"INTERVAL '{delay}'"))
        moved = rows.filter(F.col("batch") == number).agg(F.greatest(newest, F.lit(mark).cast("long")).alias("mark"))
        now = moved.first().mark
        if now is not None:
            write_partitions(totals(rows.filter(F.col("end") <= now)), table, "period")
        session.createDataFrame([(now,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/marks/{number % 2}")

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def by_period(events: DataFrame, unit: str = "month") -> DataFrame:
    """The same rows of a whole table in one batch, every period closed."""
    return totals(_as_state(_dated(events.dropna(subset=["user_id", "ts"]), unit)))
