"""The entry module without the training-data subpackage, and without a library that it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r} or name.startswith({hidden!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
from rostersync.catalogue.queries import REGISTRY
assert set(e.queries()) == set(REGISTRY) and set(e.oracle_sql()) == set(REGISTRY)
"""


@pytest.mark.parametrize("hidden", ["rostersync.llm", "corpus_pipeline", "tokenizers"])
def test_the_rest_stands_alone(hidden):
    if hidden == "tokenizers" and not (ROOT / "rostersync" / "llm").exists():
        pytest.skip("nothing needs it")
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert ("without the training-data operators" in done.stderr) == (hidden == "tokenizers")
