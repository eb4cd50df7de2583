"""Stage snapshot files as they arrive, with the rules of the batch job.

The stream carries file names only.  Each micro-batch stages its new files and nothing else,
into a partition of its own below their snapshots' (``batch``), and notes their names.  A
repeated micro-batch therefore writes the same again, and a part that arrives late adds its
rows to its snapshot.  Where files that were staged before are gone, the snapshot has been
exported anew: it is staged from all files that are there, and replaces what it held.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanlens.plans.staging import clean_credit_snapshot
from loanlens.schemas import CREDIT_KEY, CREDIT_STATUS
from loanlens.session import exists, remove
from loanlens.sources.snapshots import find_files, read_snapshots, require_columns, snapshot_and_export
from loanlens.sources.tables import write_partitions

FILES = "{*.csv,*.csv.gz}"
STAGED_FILES = "snapshot string, export string, path string, again boolean, batch long"


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Paths of the CSV files below a folder, each one once."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )


def stage_files(names: DataFrame, table: str, log: str, batch: int) -> None:
    """Stage the given files, as micro-batch ``batch``; ``log`` keeps the names of all staged files."""
    spark = names.sparkSession
    new = {row.path: snapshot_and_export(row.path) for row in names.collect()}
    if not new:
        return
    dates = sorted({date for date, _ in new.values()})
    noted = [path for path in (f"{log}/snapshot={date}" for date in dates) if exists(spark, path)]
    before = []
    if noted:
        files = spark.read.schema(STAGED_FILES).option("basePath", log).parquet(*noted)
        before = files.filter(F.col("batch") < batch).collect()
    held: dict[str, dict[str, str]] = {}
    for date in dates:
        of_date = [row for row in before if row.snapshot == date]
        last = max((row.batch for row in of_date if row.again), default=-1)
        held[date] = {row.path: row.export for row in of_date if row.batch >= last}
    seen = {date for date in dates if held[date]}
    there = _present(spark, {export for date in seen for export in held[date].values()}.union(export for date, export in new.values() if date in seen))
    again = {date: there.get(date, set()) for date in seen if held[date].keys() - there.get(date, set())}
    # Staged already if the snapshot was staged from all files.
    new = {path: of for path, of in new.items() if of[0] in again or path not in held[of[0]]}
    paths = sorted({path for path, (date, _) in new.items() if date not in again}.union(*again.values()))
    if paths:
        parts = find_files(spark, *paths)
        require_columns(parts, CREDIT_KEY, CREDIT_STATUS)
        # As text: a number would be part of the generated code, which each micro-batch would compile and warm up anew.
        staged = clean_credit_snapshot(read_snapshots(spark, parts)).withColumn("batch", F.lit(str(batch)))
        write_partitions(staged, table, "snapshot_date", "batch", rebalance=False)
        for date in again:
            remove(spark, f"{table}/snapshot_date={date}", lambda name: int(name.removeprefix("batch=")) < batch)
        columns = [field.split()[0] for field in STAGED_FILES.split(", ")]
        rows = [(*snapshot_and_export(path), path, snapshot_and_export(path)[0] in again, batch) for path in paths]
        # As one text, which needs no Python worker.
        text = F.lit(json.dumps([dict(zip(columns, row)) for row in rows]))
        noted_now = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(text, f"array<struct<{STAGED_FILES}>>")))
        write_partitions(noted_now, log, "snapshot", "batch", rebalance=False)


def _present(spark: SparkSession, exports: set[str]) -> dict[str, set[str]]:
    """The files of the exports that are there now, by snapshot."""
    found = [path for path in sorted(exports) if exists(spark, path)]
    there: dict[str, set[str]] = {}
    if found:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", FILES).load(found)
        for row in files.select("path").collect():
            there.setdefault(snapshot_and_export(row.path)[0], set()).add(row.path)
    return there


def stage_arriving_snapshots(
    spark: SparkSession, folder: str, table: str, checkpoint: str, files_per_batch: int = 1000, **trigger
) -> StreamingQuery:
    """Start staging; by default it ends once everything present has been staged."""
    return (
        arriving_files(spark, folder, files_per_batch)
        .writeStream.foreachBatch(lambda names, number: stage_files(names, table, f"{checkpoint}/staged-files", number))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
