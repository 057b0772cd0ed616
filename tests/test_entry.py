"""The entry module stands the absence of the separate folders, and of nothing else."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), sum(n == 'pipeline' or n[:2] == 'op' and n[2].isdigit() for n in q))"


def copy(target, *left_out):
    shutil.copytree(ROOT, target, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__", *left_out))
    return subprocess.run([sys.executable, "-c", COUNT], cwd=target, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{target}:{':'.join(p for p in sys.path if p and p != str(ROOT))}"}, capture_output=True, text=True)


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_without_separate_folders(tmp_path, left_out):
    done = copy(tmp_path / "copy", *left_out)
    assert done.returncode == 0, done.stderr
    total, separate = map(int, done.stdout.split())
    assert total - separate > 90
    if "llm" in left_out:
        assert separate == 0


def test_other_absences_are_errors(tmp_path):
    done = copy(tmp_path / "copy", "geo.py")
    assert done.returncode != 0 and "segloom.functions" in done.stderr
