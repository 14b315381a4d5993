"""The entry works whether or not the training-data operators are installed."""

import json
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import ROOT

ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("hidden", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_the_training_data_operators(tmp_path, hidden):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda _, names: [n for n in names if n in [*hidden, ".git", "__pycache__"]])
    got = subprocess.run([sys.executable, "-c", ASK], cwd=copy, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    queries, oracle = json.loads(got.stdout.splitlines()[-1])
    own = {k for k in entry_mod.queries() if k != "pipeline" and not k.startswith("op")}
    assert set(queries) == own
    assert set(oracle) == own & set(entry_mod.oracle_sql())
