"""The registered queries with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q))"


def count(folder) -> int:
    done = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return int(done.stdout.split()[-1])


def test_queries_without_the_llm_package(tmp_path):
    for name in ("__spark_entry__.py", "tessera"):
        path = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(path) else shutil.copy)(path, tmp_path / name)
    shutil.rmtree(tmp_path / "tessera" / "llm", ignore_errors=True)
    alone = count(tmp_path)
    assert alone > 90
    (tmp_path / "tessera" / "llm" / "__pycache__").mkdir(parents=True)
    assert count(tmp_path) == alone


def test_nothing_else_imports_the_llm_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "tessera")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "tessera.llm" not in f.read()
