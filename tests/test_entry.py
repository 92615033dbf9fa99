"""The entry without parts that it can do without."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
from verification.queries import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
print(sorted(set(entry.queries()) - set(QUERIES)))
"""


@pytest.mark.parametrize("hidden", [["zstandard"], ["tiktoken"], ["numpy", "pyarrow", "pandas"], ["commitfold.llm"], ["corpus_pipeline"]], ids=str)
def test_core_queries_stay(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    if hidden != ["corpus_pipeline"]:
        assert done.stdout.strip() == "[]"
