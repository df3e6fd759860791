"""The session's settings, and the package on the executors' side."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {repo!r})
import pyarrow as pa
from pyspark.sql import SparkSession
from tidewright import session
spark = session.build("t", "local[1]", **{{"spark.ui.enabled": "false"}})
session.ship(spark); session.ship(spark)
def run(batches):
    import tidewright.session as s
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([s.__file__] * b.num_rows)], names=["f"])
print("FROM", spark.range(1).mapInArrow(run, "f string").first().f)
"""


def test_executors_need_no_search_path(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "tidewright.zip" in out.stdout, out.stderr[-2000:]
