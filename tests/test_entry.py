"""The driver contract, run the way the driver runs it: another working directory,
a plain session, executors that do not have this package on their path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
import __spark_entry__ as e
rows = e.entry(spark).collect()
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q)
n = q['src_json_array'](spark, '/root/testdata/sf0.001').count()
print('OK', len(rows), len(q), len(o), n)
"""


def test_entry_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as d:
        out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True, text=True,
                             timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    line = [l for l in out.stdout.splitlines() if l.startswith("OK")][0]
    _, rows, nq, no, n = line.split()
    assert int(rows) > 0 and int(nq) >= int(no) > 0 and int(n) > 0
