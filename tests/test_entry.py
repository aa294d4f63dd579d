"""The entry module with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(' '.join(q))"


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_imports_without_the_optional_parts(tmp_path, left_out):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "spark-warehouse", *left_out))
    found = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert found.returncode == 0, found.stderr
    names = found.stdout.split()
    assert "b02_installation_scores" in names and "pipeline" not in names
    assert any(n.startswith("op1_") for n in names) == ("llm" not in left_out)
