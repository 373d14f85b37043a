"""The library without its corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_stands_without_the_corpus_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".*"))
    if not with_pipeline and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    told = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); print(*q)"
    out = subprocess.run([sys.executable, "-c", told], cwd=copy, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    names = out.stdout.split()
    assert "sale_kpis" in names and "pipeline" not in names and not [n for n in names if n.startswith("op1_")]
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=copy, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout[-2000:]


def test_missing_needs_of_the_corpus_operators_are_told(tmp_path):
    """Only their absence is let pass, no other fault."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".*", "corpus_pipeline.py"))
    (copy / "gavelline" / "llm").mkdir()
    (copy / "gavelline" / "llm" / "__init__.py").write_text("")
    (copy / "gavelline" / "llm" / "queries.py").write_text("import no_such_library\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True)
    assert out.returncode != 0 and "no_such_library" in out.stderr
