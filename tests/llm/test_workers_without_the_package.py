"""Executors need no copy of the package: the driver alone finds it."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from fieldwise.llm import queries
from fieldwise.session import local_session
spark = local_session(cores=2)
for name in ("op11_turn_repair", "op12_ranked_search", "op13_nearest"):
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_new_operators_run_where_only_the_driver_has_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=500)
    assert done.returncode == 0, done.stderr[-2000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op1"))
    assert len(counts) == 3 and all(int(n) > 0 for n in counts.values())
