"""Every training-data query where the Python workers start in another folder and cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, {root!r})
from judicata.session import get_session
from judicata.llm.queries import QUERIES
spark = get_session("local[4]", shuffle_partitions=4, extra={{"spark.executorEnv.PYTHONPATH": ""}})
for name in {names!r} or sorted(QUERIES):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, names=[])], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
