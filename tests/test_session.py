"""A plain local session, with no setting from outside, gets a scratch folder of its own."""
import os
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
from snapline.session import checkpoint_dir, ship_package
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
a = checkpoint_dir(spark)
ship_package(spark)
assert checkpoint_dir(spark) == a
spark.range(3).write.parquet(a + "/x")
assert spark.read.parquet(a + "/x").checkpoint().count() == 3
print("done")
"""


def test_scratch_folder_without_settings(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root, "TMPDIR": str(tmp_path)}
    got = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=240)
    assert got.stdout.strip().endswith("done"), got.stderr[-2000:]
