"""The registry works without the optional subpackage and without its libraries."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as registry
names = set(registry.queries())
assert set(registry.sales_queries()) <= names and set(registry.oracle_sql()) <= names
print(len([n for n in names if n.startswith("op") or n == "pipeline"]))
"""


@pytest.mark.parametrize("missing", ["tillstar.llm", "corpus_pipeline", "xxhash", "regex"])
def test_without_a_module_the_other_queries_remain(missing):
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(missing=missing)],
        cwd=ROOT, capture_output=True, text=True, timeout=120,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.strip() == "0"
