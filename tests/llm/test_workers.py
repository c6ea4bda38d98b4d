"""Every query on workers that have no copy of the package."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # of this process; workers start from an empty folder without it
from mediapanel.session import get_spark
spark = get_spark(master="local[4]", shuffle_partitions=4)
import __spark_entry__ as entry
from mediapanel.llm.queries import QUERIES
queries = entry.queries()
for name in [*QUERIES, "pipeline"]:
    print(name, len(queries[name](spark, "/root/testdata/sf0.001").collect()), flush=True)
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline ")))
    assert len(counts) == 14 and all(int(n) > 0 for n in counts.values())
