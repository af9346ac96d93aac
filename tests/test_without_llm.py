"""The rest works where the optional training-data package is absent."""

import os
import re
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [False, True])
def test_import_and_collect_without_the_package(tmp_path, pipeline):
    """With ``corpus_pipeline.py`` gone as well, or left behind alone."""
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as E; print(*sorted(E.queries())); assert set(E.oracle_sql()) == set(E.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}

    def run(*args):
        done = subprocess.run([sys.executable, *args], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout + done.stderr
        return done.stdout

    names = run("-c", code).split()
    assert "price_gap_daily" in names and not [n for n in names if re.match(r"op\d+_|pipeline$", n)]
    assert "error" not in run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider").lower().split("tests collected")[-1]
