"""The entry works where the training-data package, or something it needs, is missing."""

import subprocess
import sys

import pytest

from conftest import ROOT
from tracelake.plans.catalog import QUERIES

CODE = """
import sys
sys.path.insert(0, {root!r})
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(sorted(e.queries()) == sorted(e.oracle_sql()) == sorted({names!r}))
"""


@pytest.mark.parametrize("missing", [["tracelake.llm"], ["zstandard"], ["ahocorasick"], ["tokenizers"], ["tracelake.llm", "corpus_pipeline"]])
def test_other_queries_are_there_without_the_package(missing):
    code = CODE.format(root=ROOT, missing=missing, names=sorted(QUERIES))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "True", done.stderr
