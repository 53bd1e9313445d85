"""The entry file without the optional folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tallyward.plans import replays  # noqa: F401 (adds the streaming queries)
from tallyward.plans.catalog import CATALOG

ROOT = Path(__file__).resolve().parents[1]
LISTED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(len(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [["tallyward/llm", "tests/llm"], ["tallyward/llm", "tests/llm", "corpus_pipeline.py"]])
def test_the_library_stands_without_its_optional_folders(tmp_path, gone):
    skipped = {ROOT / path for path in gone}

    def left_out(folder, names):
        return [n for n in names if Path(folder, n) in skipped or n in (".git", "__pycache__", "spark-warehouse")]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    done = subprocess.run([sys.executable, "-c", LISTED], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split("\n")[0].split()
    assert set(CATALOG) == set(names)
