"""The driver's file, with and without the training-data subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def names(folder: Path) -> list[str]:
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return eval(done.stdout)


@pytest.mark.parametrize("gone", [("pageloom/llm", "tests/llm"), ("pageloom/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_is_registered_without_the_subpackage(tmp_path, gone):
    from pageloom.workload.catalog import QUERIES

    left_out = {str(ROOT / name) for name in gone}
    ignore = lambda at, found: [f for f in found if f in (".git", "__pycache__") or f"{at}/{f}" in left_out]
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=ignore)
    assert not (copy / "pageloom/llm").exists()
    assert names(copy) == sorted(QUERIES)


def test_every_query_is_registered_with_it():
    if not (ROOT / "pageloom/llm").exists():
        pytest.skip("the subpackage is not there")
    assert {"parse_pdf", "op1_multi_index", "pipeline"} <= set(names(ROOT))
