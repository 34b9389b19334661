"""The entry module, with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), any(n.startswith('op1') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("gone", [["walloom/llm"], ["walloom/llm", "corpus_pipeline.py"]])
def test_entry_without_the_corpus_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__"))
    for name in gone:
        path = copy / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    found = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    n, corpus = found.stdout.split()
    assert int(n) > 60 and corpus == "False"
