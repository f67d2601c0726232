"""The entry module without the text subpackage, its tests and with or without the pipeline's file."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent

SCRIPT = """
import __spark_entry__ as entry
names = entry.queries()
assert len(names) > 100 and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
assert set(entry.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_text_operators(tmp_path, pipeline):
    shutil.copytree(ROOT / "touchline", tmp_path / "touchline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline:
        (tmp_path / "corpus_pipeline.py").write_text("from touchline.llm import stages\n")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
