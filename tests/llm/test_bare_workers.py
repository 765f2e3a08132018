"""Every query runs where Python workers cannot import this package: the driver
alone has it on its path, workers start in another folder without PYTHONPATH."""

import os
import subprocess
import sys
import tempfile

from llm_docs import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys, tempfile
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config(
    "spark.ui.enabled", "false").config("spark.checkpoint.dir", tempfile.mkdtemp()).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def absent(batches):
    import importlib.util
    found = importlib.util.find_spec("tallyhouse") is not None
    for batch in batches:
        yield batch.assign(id=int(found))
sys.path.insert(0, sys.argv[1])
assert spark.range(4).mapInPandas(absent, "id bigint").agg({"id": "max"}).first()[0] == 0
from tallyhouse.llm import queries
for name, query in queries.all_queries().items():
    print(name, query(spark, sys.argv[2]).count(), flush=True)
"""


def test_workers_without_the_package():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as elsewhere:
        done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, SF_SMALL], cwd=elsewhere, env=env,
                              capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    from tallyhouse.llm.queries import all_queries
    assert set(counts) == set(all_queries()) and all(int(n) > 0 for n in counts.values())
