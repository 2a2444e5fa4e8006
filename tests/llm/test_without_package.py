"""Every operator where executors do not have this package: only the driver can import it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent.parent
SF_DIR = "/root/testdata/sf0.001"
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from stmtscope.llm.queries import queries
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

def importable(_):
    import importlib.util
    yield importlib.util.find_spec("stmtscope") is not None

assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == [False]
for name, query in queries().items():
    try:
        query(spark, {sf_dir!r}).write.format("noop").mode("overwrite").save()
        print("ran", name)
    except Exception as error:
        print("failed", name, str(error)[-600:])
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_every_query(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(REPO), sf_dir=SF_DIR))
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=900)
    from stmtscope.llm.queries import queries

    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert ran == list(queries()), done.stdout[-3000:] + done.stderr[-3000:]
