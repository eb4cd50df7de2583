import subprocess
import sys
from pathlib import Path

from loanlens.session import shared_dir, shared_root


def test_the_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{root}/loanlens/x-") and first != second and not Path(first).exists()


def test_a_session_without_the_setting_uses_its_warehouse():
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_root(Session()) == "hdfs:///warehouse/loanlens"


def test_nothing_is_left_when_the_application_ends(tmp_path):
    code = f"""
from loanlens.session import build_session, materialised
spark = build_session("scratch", "local[1]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}}})
assert materialised(spark.range(3), "kept").count() == 3
spark.stop()
"""
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, capture_output=True, timeout=120)
    assert list((tmp_path / "loanlens").iterdir()) == []


def test_growing_tables_are_not_held_by_every_task(spark):
    """Lines and orders are sorted, as millions of narrow keys pass for a small table."""
    from conftest import SMALL

    from loanlens.registry import adapters

    counted = adapters.loan_snapshot(spark, SMALL).select("loan_id")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
