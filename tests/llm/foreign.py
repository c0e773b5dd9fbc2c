"""Runs code in a session of its own whose workers cannot import the package."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path

START = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from hazardmarts import session
spark = session.build("elsewhere", master="local-cluster[1,1,1024]", spark__ui__enabled="false",
                      spark__sql__shuffle__partitions="2", spark__checkpoint__dir="file://" + tempfile.mkdtemp())
spark.sparkContext.setLogLevel("ERROR")
def missing(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("hazardmarts") is None])], names=["missing"])
assert spark.range(1).mapInArrow(missing, "missing boolean").first().missing
"""


def run_elsewhere(code: str) -> None:
    """The driver alone has the package on its path; it starts in another folder."""
    repo = str(Path(__file__).resolve().parent.parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env |= {"SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1"}
    with tempfile.TemporaryDirectory() as folder:
        done = subprocess.run(
            [sys.executable, "-c", START.format(repo=repo) + code], cwd=folder, env=env, capture_output=True, text=True, timeout=240
        )
    assert done.returncode == 0, done.stderr[-3000:]
