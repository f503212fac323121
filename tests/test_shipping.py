"""The package reaches executors that have no copy of it."""

import os
import subprocess
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T

from tallyfold.operators.cube import _partial_schema, _sum_respondents
from tallyfold.session import package_archive
from tests.people import DESIGN, METRICS, people

KEYS = ["week_num", "state"]
CODE = """
import sys
sys.path[:] = [p for p in sys.path if not p.endswith("/repo")] + [{archive!r}]
import pickle
import pyarrow as pa
task, batch = pickle.load(open({saved!r}, "rb"))
import tallyfold
assert tallyfold.__file__.startswith({archive!r}), tallyfold.__file__
print("rows", sum(b.num_rows for b in task([pa.RecordBatch.from_pylist(batch)])))
"""


def test_a_task_of_the_cube_runs_from_the_archive_alone(tmp_path):
    archive = package_archive(str(tmp_path))
    _, schema = _partial_schema([T.StructField(k, T.StringType()) for k in KEYS], len(DESIGN.columns))
    task = _sum_respondents(KEYS, METRICS, len(DESIGN.columns), [KEYS], schema, 100)
    rows = [{"week_num": p["week_num"], "state": p["state"], "w": p["w"], "x": [p[m] for m in METRICS]} for p in people(50)]
    expected = sum(b.num_rows for b in task([pa.RecordBatch.from_pylist(rows)]))
    saved = tmp_path / "task"
    saved.write_bytes(cloudpickle.dumps((task, rows)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(archive=archive, saved=str(saved))], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=120)
    assert f"rows {expected}" in done.stdout, done.stderr[-2000:]
