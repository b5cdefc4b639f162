import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from corpusloom.functions.text import text_hash
from corpusloom.shipping import ship
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship(spark)
ship(spark)
print("hash", spark.createDataFrame([("a b",)], "t string").select(text_hash(F.col("t"))).first()[0])
"""


def test_workers_find_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "hash " in done.stdout
