"""The library without its llm subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", [False, True])
def test_the_other_queries_without_the_subpackage(tmp_path, left):
    """With a pipeline that imports the subpackage left behind, and without one."""
    shutil.copytree(os.path.join(ROOT, "gridloom"), tmp_path / "gridloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    if left:
        (tmp_path / "corpus_pipeline.py").write_text("from gridloom.llm import packing\n\nrun, ORACLE_SQL = packing.pack, None\n")
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'qc_cascade' in q and 'qc_cascade' in o and 'pipeline' not in q; assert not [n for n in q if n.startswith('op')]"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert done.returncode == 0, done.stderr
