"""The entry module without the optional llm subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _names(folder: Path) -> list[str]:
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.splitlines()[-2].split()


def test_entry_imports_without_the_llm_folder(tmp_path):
    shutil.copytree(ROOT / "sintonia", tmp_path / "sintonia", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    names = _names(tmp_path)
    assert "gold_rating_share" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]


def _with_llm(tmp_path, code):
    shutil.copytree(ROOT / "sintonia", tmp_path / "sintonia", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "sintonia" / "llm").mkdir()
    (tmp_path / "sintonia" / "llm" / "queries.py").write_text(code)


def test_a_package_that_only_llm_needs_may_be_absent(tmp_path):
    _with_llm(tmp_path, "import no_such_package\n")
    assert "gold_rating_share" in _names(tmp_path)


def test_errors_of_the_library_are_not_hidden(tmp_path):
    for code in ("import sintonia.no_such_module\n", "1 / 0\n", "from sintonia.session import no_such_name\n"):
        folder = tmp_path / str(len(code))
        folder.mkdir()
        _with_llm(folder, code)
        out = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=folder, capture_output=True, text=True, timeout=120)
        assert out.returncode != 0
