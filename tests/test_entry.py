"""The driver entry with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def shown(folder):
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, check=True)
    return out.stdout.split()


def copied(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    return tmp_path / "repo"


def test_entry_without_the_two_folders(tmp_path):
    n, extra, named = shown(copied(tmp_path))
    assert (int(n) > 50, extra, named) == (True, "0", "True")


def test_entry_without_folders_and_pipeline(tmp_path):
    folder = copied(tmp_path)
    (folder / "corpus_pipeline.py").unlink(missing_ok=True)
    assert shown(folder)[1] == "0"


def test_other_missing_modules_are_errors(tmp_path):
    folder = copied(tmp_path)
    (folder / "corpus_pipeline.py").write_text("import no_such_module_here\n")
    with pytest.raises(subprocess.CalledProcessError):
        shown(folder)
