"""Python workers need no copy of the package: the HTML parser travels with the task."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = f"""
import sys
sys.path.insert(0, {ROOT!r})          # the driver side only; workers get no path to the package
from pyspark.sql import SparkSession
from shelfprice.sources.html_tables import html_first_table
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([(1, "<table><tr><th>a</th></tr><tr><td>x</td></tr></table>")], "page_id long, html string")
print("CELLS", [tuple(r) for r in html_first_table(df).collect()])
spark.stop()
"""


def test_udtf_runs_where_the_package_is_not_importable(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CHILD], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "CELLS [(1, 0, 0, 'a', 'x')]" in out.stdout, out.stderr[-2000:]
