"""The rest of the library without the language-model operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
TOLD = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), sorted(n for n in e.queries() if n.startswith('op')))"


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_the_rest_imports_without_the_subpackage(tmp_path, keep_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"])))
    env = {**os.environ, "PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", TOLD], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    count, pipeline, operators = out.stdout.split(maxsplit=2)
    assert int(count) > 100 and pipeline == "False" and operators.strip() == "[]"


def test_nothing_else_imports_the_subpackage():
    others = [p for p in REPO.rglob("*.py") if "llm" not in p.relative_to(REPO).parts and p.name not in ("corpus_pipeline.py", "__spark_entry__.py", Path(__file__).name)]
    assert others and not [p for p in others if "newsloom.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
