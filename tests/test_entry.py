"""The entry module, with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).resolve().parent.parent


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage(tmp_path):
    shutil.copytree(REPO / "chemlake", tmp_path / "chemlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
