"""Python workers import the package wherever the driver was started."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
from claimgauge.session import local_session, ship_package
from claimgauge.functions.run_stamp import RunMeta
spark = local_session(1, shuffle_partitions=1)
ship_package(spark)
ship_package(spark)
def where(batches):
    from claimgauge.functions import run_stamp
    yield from batches
assert spark.range(3).mapInArrow(where, "id long").count() == 3
"""


def test_workers_import_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
