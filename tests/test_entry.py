"""The driver's entry file without the text operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_text_operators(tmp_path, pipeline):
    """With the llm folder deleted, with or without ``corpus_pipeline.py``, the finance queries stay."""
    shutil.copytree(f"{ROOT}/ledgerflow", tmp_path / "ledgerflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline:
        (tmp_path / "corpus_pipeline.py").write_text("from ledgerflow.llm import common\n")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k[:2] == 'op' and k[2].isdigit() for k in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1:] == ["False", "True"]
