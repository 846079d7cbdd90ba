"""The entry module with and without the subpackage for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()), 'pipeline' in e.queries())"


def run(folder):
    done = subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, check=True)
    count, known, pipeline = done.stdout.split()
    return int(count), known, pipeline


def copy(folder, *left_out):
    skip = shutil.ignore_patterns("__pycache__", ".git", *left_out)
    shutil.copytree(ROOT / "rarescan", folder / "rarescan", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, folder / name)
    return folder


def test_all_queries_are_registered():
    count, known, _ = run(ROOT)
    assert count > 80 and known == "True"


def test_rest_works_without_the_subpackage(tmp_path):
    for number, left_out in enumerate((("llm",), ("llm", "corpus_pipeline.py"))):
        folder = tmp_path / str(number)
        folder.mkdir()
        count, known, pipeline = run(copy(folder, *left_out))
        assert count > 80 and known == "True" and pipeline == "False"
