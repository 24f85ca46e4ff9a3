"""The entry without the training-data subpackage, or without what only it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

from contract.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", [
    "cairn.llm", "corpus_pipeline", "public_tokenizers", "regex", "tiktoken", "tokenizers", "sentencepiece",
    "ahocorasick", "zstandard", "xxhash",
])
def test_reference_queries_stay_without_a_dependency(missing):
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(len(set(entry.queries()) & set(entry.oracle_sql()) & {set(QUERIES)!r}))
"""
    done = subprocess.run([sys.executable, "-c", script], text=True, capture_output=True, timeout=120)
    assert done.stdout.strip() == str(len(QUERIES)), done.stderr[-2000:]
