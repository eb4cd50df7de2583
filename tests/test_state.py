"""Metric state: what it merges to, and what a new snapshot touches."""

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from loanlens.operators import metrics, state
from loanlens.registry import adapters
from loanlens.session import shared_root


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def rounded(df):
    return rows(df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]))


def test_a_new_snapshot_touches_its_own_partition_only(spark, tmp_path):
    fct = adapters.classified(spark, SMALL)
    newest = F.col("snapshot_date") == fct.agg(F.max("snapshot_date")).scalar()
    path = str(tmp_path / "state")
    state.keep(state.portfolio_state(fct.filter(~newest)), path)
    before = files(path)
    state.keep(state.portfolio_state(fct.filter(newest)), path)
    after = files(path)
    assert before.items() < after.items()
    # A rerun replaces that partition, and nothing is counted twice.
    state.keep(state.portfolio_state(fct.filter(newest)), path)
    assert before.items() < files(path).items() and len(files(path)) == len(after)
    assert rounded(state.portfolio_kpis(spark.read.parquet(path))) == rounded(metrics.portfolio_kpis(fct))


def test_parts_of_a_snapshot_add_up(spark):
    fct = adapters.classified(spark, SMALL).withColumn("risk", F.col("risk_category"))
    halves = [state.portfolio_state(fct.filter(F.col("line_no") % 2 == k), "risk") for k in (0, 1)]
    both = halves[0].unionByName(halves[1])
    assert rounded(state.portfolio_kpis(both)) == rounded(metrics.portfolio_kpis(fct))
    assert rounded(state.segment_kpis(both, ["risk"])) == rounded(metrics.segment_kpis(metrics.book(fct), "risk"))


def session(master, root, checkpoint=None):
    conf = {"spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": root}
    hadoop = SimpleNamespace(get=lambda key, default: "hdfs://name" if key == "fs.defaultFS" and root.startswith("/shared") else default)
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf[key] or default), sparkContext=context)


def test_scratch_never_goes_to_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session("spark://host:7077", "file:/home/me/spark-warehouse"))
    assert shared_root(session("local[4]", "file:/tmp/w")) == "file:/tmp/w/loanlens"
    assert shared_root(session("yarn", "s3a://bucket/w")) == "s3a://bucket/w/loanlens"
    assert shared_root(session("yarn", "/shared/w")) == "/shared/w/loanlens"
    assert shared_root(session("yarn", "file:/w", "hdfs:///tmp")) == "hdfs:///tmp/loanlens"


def test_queries_stay_without_packages_that_only_training_data_needs():
    code = ("import sys; sys.modules['ahocorasick'] = None; sys.modules['tiktoken'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') and n[2].isdigit() for n in e.queries()))")
    root = Path(__file__).parents[1]
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": str(root)}, capture_output=True, text=True, check=True)
    assert int(done.stdout.split()[0]) >= 84 and done.stdout.split()[1] == "False"
