from conftest import SMALL, rows
from pyspark.sql import functions as F

from loanlens.plans.staging import clean_credit_snapshot
from loanlens.registry import adapters, q_sources
from loanlens.streaming import snapshots
from loanlens.streaming.snapshots import stage_arriving_snapshots, stage_files


def write(df, root):
    adapters.write_snapshot_files(df, root)


def test_arriving_files_give_the_batch_result(spark, tmp_path):
    root, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    raw = adapters.raw_credit(spark, SMALL)
    newest = F.year("snapshot_date") == 2001

    def staged():
        return rows(spark.read.parquet(table).select(clean_credit_snapshot(raw).columns))

    def run():
        stage_arriving_snapshots(spark, root, table, log, files_per_batch=3).awaitTermination()

    half = F.col("CREDIT_CHECK_DONE") == "F"
    write(raw.filter(~newest), root)
    write(raw.filter(newest & half), root)
    run()
    assert staged() == rows(clean_credit_snapshot(raw.filter(~newest | half)))
    run()
    assert staged() == rows(clean_credit_snapshot(raw.filter(~newest | half)))
    # Another part of the newest export comes later: the whole snapshot is staged again.
    write(raw.filter(newest & ~half), root)
    run()
    assert staged() == rows(clean_credit_snapshot(raw))


def test_each_file_is_staged_once_and_a_new_export_replaces_the_old(spark, tmp_path):
    root, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    raw = adapters.raw_credit(spark, SMALL).filter(F.year("snapshot_date") >= 2000)
    newest, half = F.year("snapshot_date") == 2001, F.col("CREDIT_CHECK_DONE") == "F"

    def run():
        stage_arriving_snapshots(spark, root, table, log, files_per_batch=2).awaitTermination()
        return spark.read.parquet(table)

    write(raw.filter(half), root)
    first = rows(run())
    # More parts of the same snapshots: what is staged stays as it is.
    write(raw.filter(~newest & ~half), root)
    assert set(first) < set(rows(run()))
    # The newest export is written anew, under other names and with fewer rows.
    for file in next((tmp_path / "in").glob("*2001*")).glob("*"):
        file.unlink()
    other = raw.filter(newest & F.col("BALANCE_DUE_STATUS").contains("A"))
    write(other.repartition(3), root)
    whole = clean_credit_snapshot(raw.filter(~newest).unionByName(other))
    assert rows(run().select(whole.columns)) == rows(whole)
    assert rows(run().select(whole.columns)) == rows(whole)


def test_a_micro_batch_takes_few_jobs_whatever_is_held(spark, tmp_path):
    """Names and listings come in one job each, not in one for every file of every snapshot concerned."""
    root, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    raw = adapters.raw_credit(spark, SMALL)
    write(raw.repartition(8), root)
    exports = [sorted(f"file:{path}" for path in folder.glob("*.gz")) for folder in sorted((tmp_path / "in").glob("export=*"))]
    assert len(exports) > 4 and min(map(len, exports)) == 8

    def jobs():
        return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()

    taken = []
    for batch in range(8):
        before = jobs()
        stage_files(spark.createDataFrame([(files[batch],) for files in exports], "path string"), table, log, batch)
        taken.append(jobs() - before)
    # The second is the first that looks for the files held.
    assert max(taken) <= 14, taken
    assert rows(spark.read.parquet(table).drop("batch").select(clean_credit_snapshot(raw).columns)) == rows(clean_credit_snapshot(raw))


def test_the_number_of_a_micro_batch_is_no_part_of_its_code(spark, tmp_path, monkeypatch):
    """A constant text is handed to the generated code, a number is written into it and has it compiled anew."""
    root, table, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    raw = adapters.raw_credit(spark, SMALL)
    write(raw, root)
    kinds, write_partitions = {}, snapshots.write_partitions

    def noted(df, path, *by, **how):
        kinds[path] = dict(df.dtypes)["batch"]
        write_partitions(df, path, *by, **how)

    monkeypatch.setattr(snapshots, "write_partitions", noted)
    stage_files(spark.createDataFrame([(f"file:{path}",) for path in (tmp_path / "in").glob("*/*.gz")], "path string"), table, log, 7)
    assert kinds == {table: "string", log: "bigint"}
    staged = spark.read.parquet(table)
    assert [r.batch for r in staged.select("batch").distinct().collect()] == [7]
    assert staged.count() == clean_credit_snapshot(raw).count()


def test_the_query_writes_few_files(spark, tmp_path, monkeypatch):
    """Small tasks of the join leave no file each for every snapshot."""
    files = []

    def counted(session, root, *args, **kwargs):
        files.append(session.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(root).count())
        return stage_arriving_snapshots(session, root, *args, **kwargs)

    monkeypatch.setattr(q_sources, "stage_arriving_snapshots", counted)
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    was = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        found = rows(q_sources.stream_snapshot_csv(spark, SMALL))
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)
    whole = clean_credit_snapshot(adapters.raw_credit(spark, SMALL))
    assert found == rows(whole.select(q_sources.stream_snapshot_csv(spark, SMALL).columns))
    dates = whole.select("snapshot_date").distinct().count()
    assert files[0] <= spark.sparkContext.defaultParallelism * (dates + 1)
