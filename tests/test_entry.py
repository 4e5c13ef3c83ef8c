"""The driver contract: entry() smoke run and every registered query against its DuckDB SQL."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E
from tools.compare import canon, duck
from wardline.plans.analogues import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "final_total_revenue" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("gone", [["wardline/llm", "tests/llm"], ["wardline/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_optional_parts_may_be_deleted(tmp_path, gone):
    """The entry of a copy without the training-data operators has all other queries."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    copy = str(tmp_path / "copy")
    left_out = {os.path.join(root, g) for g in gone}
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in {".git", "__pycache__"} or os.path.join(d, n) in left_out])
    say = "import json, __spark_entry__ as E; print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))"
    out = subprocess.run([sys.executable, "-c", say], cwd=copy, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": copy})
    names, sql = json.loads(out.stdout.strip().splitlines()[-1])
    assert set(QUERIES) <= set(names) and set(QUERIES) <= set(sql)
    assert any(n.startswith("op") for n in names) == ("wardline/llm" not in gone) and "pipeline" not in names


def test_tasks_find_the_package_from_another_folder(tmp_path):
    """A session that starts elsewhere: the Python workers of a query import the package all the same."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    say = (f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as E; from wardline.session import local_session; "
           f"print(E.queries()['accept_in_order'](local_session(2), {SF!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", say], cwd=tmp_path, capture_output=True, text=True, env=env)
    assert out.stdout.strip().endswith("1000"), out.stderr[-2000:]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got == want
