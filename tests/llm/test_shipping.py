import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent.parent

SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from __spark_entry__ import queries
from ratemill.session import build_session, remove_scratch
spark = build_session("elsewhere", **{{"spark.master": "local[2]", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": sys.argv[1], "spark.sql.warehouse.dir": sys.argv[1]}})
print("rows", len(queries()["op12_quality_ranking"](spark, "/root/testdata/sf0.001").collect()))
remove_scratch(spark)
spark.stop()
"""


def test_workers_elsewhere_get_the_package(tmp_path):
    """Started from another folder, Python workers find the package only if it was sent to them."""
    (tmp_path / "shared").mkdir()
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "run.py", str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 200" in run.stdout, run.stderr[-2000:]
    assert not list((tmp_path / "shared").glob("ratemill-*"))
