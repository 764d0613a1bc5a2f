"""The queries run where only the driver can import the library."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SMALL

SCRIPT = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "2g").getOrCreate())
from __spark_entry__ import queries
qs = queries()
for name in sorted(n for n in qs if n in ("pipeline", "op2_quality_classifier", "op4_toxicity", "op9_html_text", "op10_decontaminate")):
    print("DONE", name, len(qs[name](spark, {SMALL!r}).collect()))
spark.stop()
"""


def test_workers_need_no_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.count("DONE") == 5, out.stderr[-2000:]
