"""The entry module with and without the training-data folders."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def _names(folder) -> tuple[set[str], set[str]]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=folder, env=env, capture_output=True, text=True, timeout=120, check=True)
    queries, oracles = said.stdout.splitlines()
    return set(queries.split()), set(oracles.split())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_loads_without_training_data_folders(tmp_path, pipeline):
    skipped = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skipped)
    queries, oracles = _names(tmp_path / "copy")
    assert "self_witness_query" in queries and "pipeline" not in queries
    assert not any(q.startswith("op") and q[2].isdigit() for q in queries)
    assert oracles <= queries
