"""The driver's contract, and the core without the subpackage for training data."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from quirework.plans import queries, task_queries

ROOT = Path(__file__).resolve().parent.parent


def test_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_imports_the_subpackage():
    for p in (ROOT / "quirework").rglob("*.py"):
        if "llm" not in p.parts:
            assert "quirework.llm" not in p.read_text(), p


def test_entry_without_the_subpackage(tmp_path):
    code = "import sys; sys.modules['quirework.llm'] = None; import __spark_entry__ as e; assert not [k for k in e.queries() if k.startswith('p1_')]; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout) == len(queries.QUERIES | task_queries.QUERIES), out.stderr


def test_every_core_query_has_sql():
    assert set(queries.QUERIES | task_queries.QUERIES) <= set(entry.oracle_sql()) and not set(queries.QUERIES) & set(task_queries.QUERIES)
