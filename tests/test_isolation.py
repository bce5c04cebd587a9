"""Without the folders of the llm operators everything else still imports, with or without the pipeline's file."""

import json
import os
import shutil
import subprocess
import sys

import pytest

from tickloom.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"], ["corpus_pipeline.py", "tickloom/llm/__pycache__"]])
def test_entry_imports_without_llm(tmp_path, left):
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/tickloom", f"{tmp_path}/tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in left:
        if name.endswith(".py"):
            if os.path.exists(f"{ROOT}/{name}"):
                shutil.copy(f"{ROOT}/{name}", tmp_path)
        else:
            os.makedirs(f"{tmp_path}/{name}")
    code = "import json, bench, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    names, sql = json.loads(done.stdout.splitlines()[-1])
    assert names == sorted(QUERIES) and sql == sorted(QUERIES)
