"""The driver contract, with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).parents[1]


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_survive_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'term_counts' in q and not any(k.startswith('op1') for k in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    files = [p for p in (ROOT / "vokaflow").rglob("*.py") if "llm" not in p.parts]
    assert files and not any("vokaflow.llm" in p.read_text() for p in files)
