import os
import subprocess
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", {os.path.join(REPO, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
for name in ("knn_vote", "match_fuzzy"):
    assert entry.queries()[name](spark, {FOLDER!r}).count() > 0
print("both ran")
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_workers_find_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "both ran" in done.stdout, done.stderr[-3000:]
