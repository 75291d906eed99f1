"""The package reaches Python workers that cannot import it by themselves."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from trendloom.operators.knn import knn_graph
from trendloom.session import local_session, ship_package
spark = local_session("2")
ship_package(spark)
ship_package(spark)
df = spark.createDataFrame([(i, [float(i), 1.0, float(i % 3)]) for i in range(12)], "vec_id long, embedding array<double>")
print("rows", knn_graph(df, 3).count())
"""


def test_neighbours_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 36" in done.stdout, done.stderr[-2000:]
