"""The driver's entry with libraries or folders missing."""
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["ahocorasick", "zstandard", "xxhash", "riskwin.llm", "corpus_pipeline"])
def test_a_missing_module_costs_no_core_query(missing):
    code = f"""import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ImportError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as se
from riskwin.plans.catalog import catalog
assert set(catalog()) <= set(se.queries()) and set(catalog()) <= set(se.oracle_sql()) <= set(se.queries())
import os
left = [q for q in se.queries() if q.startswith("op")]
assert bool(left) == (os.path.isdir("riskwin/llm") and {missing!r} != "riskwin.llm")
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
