"""The library without its training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_works_without_the_training_data_operators(tmp_path):
    for pipeline in (True, False):
        copy = tmp_path / str(pipeline)
        copy.mkdir()
        for name in ("lexmill", "checks", "tests"):
            shutil.copytree(ROOT / name, copy / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ("__spark_entry__.py", "bench.py", *["corpus_pipeline.py"] * pipeline):
            shutil.copy(ROOT / name, copy / name)
        done = subprocess.run(
            [sys.executable, "-c", "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
             "assert len(q) > 100 and set(s) <= set(q) and 'pipeline' not in q and not any('op1_' in n for n in q)"],
            cwd=copy, capture_output=True, text=True)
        assert not done.returncode, done.stderr
        found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"],
                               cwd=copy, capture_output=True, text=True)
        assert not found.returncode, found.stdout
