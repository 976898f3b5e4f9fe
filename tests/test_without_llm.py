"""The entry point without the training-data folder."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_everything_else_imports(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "quotewright", tmp_path / "quotewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), 'series_returns' in e.queries(), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=True)
    assert out.stdout.split() == ["True", "True", "False"]
