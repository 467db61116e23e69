"""The entry point with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True, timeout=120)
    return [line.split() for line in out.stdout.strip().split("\n")[-2:]]


def test_imports_without_the_operators(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tallyforge", tmp_path / "tallyforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    queries, oracle = names(tmp_path)
    assert "bars_1h" in queries and "bars_1h" in oracle and not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_entry_runs(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
