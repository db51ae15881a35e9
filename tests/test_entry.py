"""The entry works without the optional training-data part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = """
import sys
{before}
import __spark_entry__ as entry
names = entry.queries()
assert "group_multi_agg" in names and len(names) > 200, len(names)
assert set(entry.oracle_sql()) <= set(names)
assert "pipeline" not in names and not any(n.startswith("op1_") for n in names)
"""


@pytest.mark.parametrize("before", ["", "sys.modules['public_tokenizers'] = None"])
def test_entry_without_the_training_data_part(tmp_path, before):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json"))
    if not before:
        shutil.rmtree(tmp_path / "copy" / "tidewater" / "llm", ignore_errors=True)
        shutil.rmtree(tmp_path / "copy" / "tests" / "llm", ignore_errors=True)
    subprocess.run([sys.executable, "-c", PROBE.format(before=before)], cwd=tmp_path / "copy", check=True, timeout=120)
