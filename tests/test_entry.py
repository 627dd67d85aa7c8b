"""The entry module with and without the optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copied(folder: Path) -> Path:
    shutil.copy(REPO / "__spark_entry__.py", folder)
    shutil.copytree(REPO / "dealerlake", folder / "dealerlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return folder


def counts(folder: Path, code: str = COUNT) -> list[int]:
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True, timeout=120)
    return [int(n) for n in out.stdout.split()]


@pytest.fixture(scope="module")
def warehouse_only():
    from dealerlake import workload, workload_sql

    return [len(workload.queries()), len(workload_sql.oracle_sql())]


def test_without_the_corpus_operators(tmp_path, warehouse_only):
    assert counts(copied(tmp_path)) == warehouse_only


def test_with_nothing_left_of_them_but_a_cache_folder(tmp_path, warehouse_only):
    left = copied(tmp_path) / "dealerlake" / "llm" / "__pycache__"
    left.mkdir(parents=True)
    (left / "queries.cpython-313.pyc").write_bytes(b"")
    assert counts(tmp_path) == warehouse_only


def test_with_a_library_of_theirs_missing(warehouse_only):
    hidden = "import sys; sys.modules['numpy'] = None; sys.modules['pyarrow'] = None; " + COUNT
    assert counts(REPO, hidden) == warehouse_only
