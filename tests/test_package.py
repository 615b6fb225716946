"""The package without its training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LISTING = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("gone", [["roadpulse/llm", "tests/llm"], ["roadpulse/llm", "tests/llm", "corpus_pipeline.py"]])
def test_imports_without_the_training_data_folders(tmp_path, gone):
    copy = tmp_path / "copy"
    skipped = {str(ROOT / name) for name in gone} | {str(ROOT / ".git")}
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if f"{folder}/{n}" in skipped or n == "__pycache__"])
    assert not any((copy / name).exists() for name in gone)
    done = subprocess.run([sys.executable, "-c", LISTING], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    others, training, listed = done.stdout.split()
    assert int(others) > 140 and training == "0" and listed == "True"
