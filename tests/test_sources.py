from pathlib import Path

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from loanlens.plans import staging
from loanlens.sources import first_lines, headers, snapshots, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Credit_Data_-_01-01-2025.csv").write_text(
        "LOAN_ID,DATE,BALANCE,ARREARS,ACCOUNT_STATUS_L1,ACCOUNT_STATUS_L2,BALANCE_DUE_STATUS\n"
        " rec1 ,1/1/2025,10,4,Active,Active,Arrears\n"
        "#N/A,1/1/2025,11,0,Active,Active,advance\n"
        "rec2,1/1/2025,12,0,Demo,Active,up to date\n"
        '"rec,3",1/1/2025,N/A,0,Active,,up to date\n'
    )
    export = tmp_path / "Credit_Data_-_30-03-2025.csv"
    export.mkdir()
    header = "BALANCE,LOAN_ID,,DATE,ARREARS,ACCOUNT_STATUS_L1,ACCOUNT_STATUS_L2,RETURN_DATE\n"
    (export / "part-0.csv").write_text(header + "10.5,rec1,,3/31/2025,4.0,Active,Active,00:00.0\n")
    (export / "part-1.csv").write_text(header + "20.5,rec4,,3/31/2025,5.5, demo ,Active,00:00.0\n")
    return tmp_path


def test_drifting_files_become_one_table(spark, folder):
    raw = snapshots.read_snapshot_files(spark, f"{folder}/{snapshots.FILE_GLOB}", drop_blank=True)
    assert not any(headers.BLANK_HEADER.match(c) for c in raw.columns)
    clean = staging.clean_credit_snapshot(raw)
    got = rows(clean.select("snapshot_date", "loan_id", "reporting_date", "balance", "arrears", "balance_due_status", "return_date"))
    assert got == sorted([
        (day("2025-01-01"), "rec,3", day("2025-01-01"), None, 0.0, "up to date", None),
        (day("2025-01-01"), "rec1", day("2025-01-01"), 10.0, 4.0, "arrears", None),
        (day("2025-03-30"), "rec1", day("2025-03-31"), 10.5, 4.0, None, None),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_blank_header_is_kept_when_asked_or_when_filled(spark, folder):
    kept = snapshots.read_snapshot_files(spark, f"{folder}/{snapshots.FILE_GLOB}")
    assert any(headers.BLANK_HEADER.match(c) for c in kept.columns)
    df = spark.createDataFrame([("a", None, "x"), ("b", None, None)], "k string, _c1 string, _c2 string")
    assert headers.drop_blank_headers(df).columns == ["k", "_c2"]


def test_report_accounts_for_every_row(spark, folder):
    raw = snapshots.read_snapshot_files(spark, f"{folder}/{snapshots.FILE_GLOB}")
    report = {(str(r.snapshot_date), r.metric): r.value for r in staging.credit_report(raw).collect()}
    for date, (rows_in, test, null, out) in {"2025-01-01": (4, 1, 1, 2), "2025-03-30": (2, 1, 0, 1)}.items():
        assert [report[date, m] for m in ("rows_in", "dropped_test_row", "dropped_null_key", "rows_out")] == [rows_in, test, null, out]
        assert rows_in == test + null + out


def test_parts_of_an_export_are_read_by_name(spark, tmp_path):
    export = tmp_path / "Credit_Data_-_30-03-2025.csv"
    export.mkdir()
    (export / "part-0.csv").write_text("LOAN_ID,BALANCE\nrec1,1\n")
    (export / "part-1.csv").write_text("BALANCE,loan_id \n2,rec2\n")
    (export / "part-2.csv").write_text("")
    raw = snapshots.read_snapshot_files(spark, f"{tmp_path}/{snapshots.FILE_GLOB}", required=("LOAN_ID",))
    assert rows(raw.select("LOAN_ID", "BALANCE")) == [("rec1", "1"), ("rec2", "2")]


@pytest.mark.parametrize("first", [True, False])
def test_header_case_does_not_lose_a_snapshot(spark, tmp_path, first):
    names = ["LOAN_ID,ACCOUNT_STATUS_L1,BALANCE", "loan_id,Account_Status_L1,balance"]
    for date, header in zip(("01-01-2025", "02-01-2025"), names if first else names[::-1]):
        (tmp_path / f"Credit_Data_-_{date}.csv").write_text(f"{header}\nrec1,Active,5\n")
    clean = staging.clean_credit_snapshot(snapshots.read_snapshot_files(spark, f"{tmp_path}/{snapshots.FILE_GLOB}"))
    assert rows(clean.select("loan_id", "balance")) == [("rec1", 5.0)] * 2


def test_snapshot_without_key_or_status_stops(spark, tmp_path):
    (tmp_path / "Credit_Data_-_01-01-2025.csv").write_text("LOAN_ID,ACCOUNT_STATUS_L1\nrec1,Active\n")
    (tmp_path / "Credit_Data_-_02-01-2025.csv").write_text("BALANCE,ACCOUNT_STATUS_L1\n1,Active\n")
    with pytest.raises(ValueError, match=r"02-01-2025.*LOAN_ID"):
        snapshots.read_snapshot_files(spark, f"{tmp_path}/{snapshots.FILE_GLOB}")
    with pytest.raises(ValueError, match="LOAN_ID"):
        staging.clean_credit_snapshot(spark.createDataFrame([("5", "Active", "2025-01-01")], "BALANCE string, ACCOUNT_STATUS_L1 string, snapshot_date string"))


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / str(n)
        for i in range(n):
            export = folder / f"Credit_Data_-_{i % 28 + 1:02d}-{i // 28 + 1:02d}-2025.csv"
            export.mkdir(parents=True)
            for part in range(2):
                (export / f"part-{part}.csv").write_text("LOAN_ID,,ACCOUNT_STATUS_L1\nrec1,,Active\n")
        spark.sparkContext.setJobGroup(f"headers-{n}", "")
        found = snapshots.find_snapshots(spark, f"{folder}/{snapshots.FILE_GLOB}")
        spark.sparkContext.setJobGroup("", "")
        assert len(found) == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{n}"))

    assert jobs(2) == jobs(30)


def test_table_parts_with_other_column_order(spark, tmp_path):
    folder = tmp_path / "Income Level"
    folder.mkdir()
    (folder / "part-0.csv").write_text("Loan Id,Gender\nrec1,Male\n")
    (folder / "part-1.csv").write_text("Gender,Loan Id \nFemale,rec2\n")
    table = tables.read_text_table(spark, str(folder))
    assert rows(table.select("Loan Id", "Gender")) == [("rec1", "Male"), ("rec2", "Female")]


def test_survey_parts_that_disagree_stop(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Loan Id,Why?\nrec1,x\n")
    (tmp_path / "b.csv").write_text("Why?,Loan Id\nx,rec1\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_survey(spark, str(tmp_path)).collect()


def test_follow_up_question_keeps_its_header(spark):
    asked = "Have you ever had your phone lock despite making a payment on time?"
    follow = "If you have ever had your phone lock despite making a payment on time, how often?"
    df = spark.createDataFrame([("9", "Yes", "twice")], f"`On a scale from 0 to 10?` string, `{asked}` string, `{follow}` string")
    assert staging.rename_survey(df).columns == ["nps_score", "phone_locked_despite_payment", follow]
    branded = df.withColumnRenamed(asked, "Have you used the  Some App to manage your account or make payments?")
    assert "uses_app" in staging.rename_survey(branded).columns
    with pytest.raises(ValueError, match="several survey headers"):
        staging.rename_survey(df.withColumn(asked.upper() + " ", F.lit("No")))


def test_file_without_date_is_an_error(spark):
    paths = spark.createDataFrame([("/x/Credit_Data_-_latest.csv",)], "p string")
    with pytest.raises(Exception, match="no snapshot date"):
        paths.select(snapshots.snapshot_date_of(F.col("p"))).collect()
    good = spark.createDataFrame([("f:/x/Credit_Data_-_30-12-2025.csv",), ("f:/x/Credit_Data_-_01-02-2025.csv/part-9.csv",)], "p string")
    assert [r[0] for r in good.select(snapshots.snapshot_date_of(F.col("p"))).collect()] == [day("2025-12-30"), day("2025-02-01")]


def test_survey_text_with_commas_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text(
        'Submission ID,Loan Id,"On a scale from 0 to 10, how likely?",Why?,'
        '"Have you ever had your phone lock despite making a payment on time?"\n'
        's1, rec1 ,9,"good, but ""slow""\nand late ",Yes\n'
        "s2,rec1,,x,No\n"
        "s3,,7,x,No\n"
        ",,,,\n"
    )
    raw = tables.read_survey(spark, str(path))
    clean = staging.clean_survey(raw)
    assert [tuple(r) for r in clean.collect()] == [("s1", "rec1", 9.0, 'good, but "slow"\nand late', "Yes", "Promoter")]
    assert clean.columns == ["submission_id", "loan_id", "nps_score", "Why?", "phone_locked_despite_payment", "nps_segment"]
    report = {r.metric: r.value for r in staging.survey_report(raw).collect()}
    assert report == {"rows_in": 3, "without_loan": 1, "without_score": 1, "rows_out": 1, "unique_keys": 1}


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Loan Id ` int, `SALE TYPE` int")
    assert headers.strip_headers(df).columns == ["Loan Id", "SALE TYPE"]
    assert headers.snake_headers(headers.strip_headers(df)).columns == ["loan_id", "sale_type"]
    assert headers.pick_header(df, "sale type") == "SALE TYPE"
    with pytest.raises(ValueError):
        headers.pick_header(df, "scale from 0")


def test_partition_overwrite_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, snapshot_date string")
    tables.write_partitions(df, path)
    tables.write_partitions(df.filter("v = 2").withColumn("v", F.lit(9)), path)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


def test_log_grows_and_report_is_one_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "n int, t string")
    for _ in range(3):
        tables.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3
    tables.write_result(df, str(tmp_path / "report"))
    files = list((tmp_path / "report").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text() == "n,t\n1,x\n"


def test_headers_cost_one_block_a_file(spark, tmp_path):
    """Of a long file, only the block that holds its first line is read."""
    long = tmp_path / "Credit_Data_-_30-03-2025.csv"
    with long.open("wb") as file:
        file.write(b"LOAN_ID,BALANCE\r\n" + b"rec1,1\n" * 1000)
        file.seek(3_000_000_000)
        file.write(b"\n")
    (tmp_path / "Credit_Data_-_30-06-2025.csv").write_text("LOAN_ID," + ",".join(f"c{i}" for i in range(30_000)) + "\nrec1\n")
    (tmp_path / "Credit_Data_-_30-09-2025.csv").write_text("LOAN_ID,odd name ü%20")
    before = read_bytes()
    found = snapshots.find_snapshots(spark, f"{tmp_path}/{snapshots.FILE_GLOB}")
    assert read_bytes() - before < 100_000_000
    assert [len(p.header) for p in found] == [2, 30_001, 2] and found[2].header[1] == "odd name ü%20"


def read_bytes():
    """Bytes that this process and those it started have read, from disk or cache."""
    import psutil

    here = psutil.Process()
    return sum(p.io_counters().read_chars for p in [here, *here.children(recursive=True)] if p.is_running())


def test_headers_where_only_spark_reads(spark, folder, monkeypatch):
    ranged = snapshots.find_snapshots(spark, f"{folder}/{snapshots.FILE_GLOB}")
    monkeypatch.setattr(first_lines, "RANGED", ())
    assert snapshots.find_snapshots(spark, f"{folder}/{snapshots.FILE_GLOB}") == ranged


def test_snapshot_files_take_no_shuffle(spark, tmp_path):
    """Every task writes its part of every snapshot."""
    from loanlens.registry.adapters import write_snapshot_files

    day = F.when(F.col("id") % 2 == 0, F.lit("2020-01-01")).otherwise(F.lit("2021-01-01")).cast("date")
    raw = spark.range(0, 90, 1, 3).select(F.col("id").cast("string").alias("LOAN_ID"), day.alias("snapshot_date"))
    write_snapshot_files(raw, str(tmp_path / "raw"))
    exports = sorted((tmp_path / "raw").glob("export=*"))
    assert [len(list(e.glob("part-*"))) for e in exports] == [3, 3]
    assert spark.read.option("header", True).csv(str(tmp_path / "raw")).count() == 90
