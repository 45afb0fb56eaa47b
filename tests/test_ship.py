"""The package reaches Python workers of a session started somewhere else."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
sys.path.remove({repo!r})
print("rows", e.queries()["g1_wkb_round_trip"](spark, "/root/testdata/sf0.001").count())
print("again", e.queries()["s8_export_layers"](spark, "/root/testdata/sf0.001").count())
"""


def test_arrow_functions_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=str(REPO))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 1500" in done.stdout and "again" in done.stdout, done.stderr[-2000:]
