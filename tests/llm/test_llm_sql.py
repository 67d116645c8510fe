"""Registered queries against their SQL, and the entry points without the subpackage."""

import subprocess
import sys

import pytest
from oracle import difference

from segmill.llm.queries import REGISTRY

SQL = [name for name, (_, sql) in REGISTRY.items() if sql is not None]


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, sf_dir, name):
    query, sql = REGISTRY[name]
    assert difference(query(spark, sf_dir), duck, sql) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_the_rest_imports_without_the_subpackage(tmp_path):
    import os
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    copy = tmp_path / "repo"
    shutil.copytree(
        root, copy, ignore=lambda d, names: [n for n in names if n in ("llm", ".git", "corpus_pipeline.py", "__pycache__")]
    )
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, ops, pipeline = out.stdout.split()
    assert int(n) > 70 and ops == pipeline == "False"
