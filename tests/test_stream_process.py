"""A stream is planned in a Python process of its own, which sees neither the driver's path nor files added to the session."""

import os
import subprocess
import sys
from pathlib import Path

from rows import SF

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from gridloom import queries
print("rows:", queries.stream_ingest(spark, sys.argv[2]).count())
"""


def test_a_stream_runs_wherever_the_driver_was_started(tmp_path):
    root = Path(__file__).resolve().parents[1]
    known = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, str(root), SF], cwd=tmp_path, env=known, capture_output=True, text=True, timeout=300)
    assert "rows: 150" in done.stdout, done.stderr[-2000:]
