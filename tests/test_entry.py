"""The entry works with and without its optional modules."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def run_in(folder: Path) -> subprocess.CompletedProcess:
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, env=clean)


def copied(folder: Path, *left_out: str) -> Path:
    """The library and the files at the top, without some folders of the library."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, folder)
    shutil.copytree(ROOT / "tickloom", folder / "tickloom", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    return folder


def names(folder: Path) -> set[str]:
    done = run_in(folder)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def test_without_the_optional_folder(tmp_path):
    """The file at the top that needs the folder may still be there, or be gone too."""
    left = names(copied(tmp_path, "llm"))
    assert "fact_trades_1h" in left and not any(n.startswith("op") or n == "pipeline" for n in left)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    assert names(tmp_path) == left
    (tmp_path / "tickloom" / "llm" / "__pycache__").mkdir(parents=True)
    assert names(tmp_path) == left


def test_errors_inside_a_module_are_not_hidden(tmp_path):
    copied(tmp_path, "llm")
    (tmp_path / "tickloom" / "llm").mkdir()
    (tmp_path / "tickloom" / "llm" / "__init__.py").touch()
    (tmp_path / "tickloom" / "llm" / "queries.py").write_text("import a_module_that_is_missing\n")
    done = run_in(tmp_path)
    assert done.returncode != 0 and "a_module_that_is_missing" in done.stderr
