import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as driver
from registered import cleaning, enrichment, ingestion, marts

ROOT = os.path.dirname(os.path.abspath(driver.__file__))
OWN = {name for module in (cleaning, enrichment, ingestion, marts) for name in module.QUERIES}
LIST = "import __spark_entry__ as d; print(*sorted(d.queries())); print(len(set(d.oracle_sql()) - set(d.queries())))"


@pytest.mark.parametrize("without", [("tidegrid/llm", "tests/llm"), ("tidegrid/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_imports_without_the_text_operators(tmp_path, without):
    tree = tmp_path / "tree"
    left = {os.path.join(ROOT, name) for name in without} | {os.path.join(ROOT, ".git")}
    shutil.copytree(ROOT, tree, ignore=lambda folder, names: [n for n in names if os.path.join(folder, n) in left])
    done = subprocess.run([sys.executable, "-c", LIST], cwd=tree, capture_output=True, text=True, check=True)
    names, strays = done.stdout.splitlines()
    assert set(names.split()) == OWN and strays == "0"
