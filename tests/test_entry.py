"""The entry works without the training-data operators."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDDEN = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names and "top_documents" in names, names
print(sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


def without(*hidden):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden)], cwd=HERE, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_imports_without_the_subpackage():
    assert without("lexshelf.llm") == "[]"


def test_imports_without_the_pipeline_or_a_library():
    assert "op8_simhash" in without("corpus_pipeline") and "pipeline" not in without("corpus_pipeline")
    assert without("duckdb", "tiktoken", "xxhash") == "[]"
