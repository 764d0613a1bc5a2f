"""The driver's entry works without the text operators, or without a package that only they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None          # an import of it raises ImportError
import warnings
warnings.simplefilter("ignore")
import __spark_entry__ as entry
names = set(entry.queries())
assert {{"loan_delinquency", "best_action"}} <= names and not any(n.startswith("op") for n in names), names
assert "pipeline" not in names and set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("blocked", [["arrears.llm"], ["corpus_pipeline"], ["xxhash", "public_tokenizers", "tokenizers"]])
def test_lending_queries_without_the_text_part(blocked):
    if blocked[0] != "arrears.llm" and not os.path.isdir(os.path.join(ROOT, "arrears", "llm")):
        pytest.skip("no text operators here")
    subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, check=True, timeout=120)
