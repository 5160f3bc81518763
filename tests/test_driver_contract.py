"""The entry module loaded by path from another working directory, in a fresh process.

Python workers must be able to import this package even when it is not on
their path (the forest and the report formats run pandas functions on executors).
"""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert m.entry(spark).count() >= 0
q = m.queries()
print("RISK", q["risk_scores"](spark, "/root/testdata/sf0.001").count())
print("LINES", q["top_vessel_lines"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="vt-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "RISK 14" in out.stdout and "LINES" in out.stdout, out.stdout
