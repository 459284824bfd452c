"""The entry file before any session exists."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_are_listed_without_a_session():
    code = "import __spark_entry__ as E; print(len(E.queries()) - len(E.oracle_sql()) > 0, set(E.oracle_sql()) <= set(E.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-2:] == ["True", "True"], out.stderr[-500:]
