"""The driver contract, with and without the text operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
WITHOUT_TEXT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["givingledger", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert "donor_export" in e.queries() and not any(q.startswith("op") or q == "pipeline" for q in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_works_without_the_text_operators():
    subprocess.run([sys.executable, "-B", "-c", WITHOUT_TEXT], cwd=ROOT, check=True)
