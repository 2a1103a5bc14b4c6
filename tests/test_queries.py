"""Every registered query against its SQL check."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_point
from deedmill.registry.oracle import ORACLE
from deedmill.registry.queries import QUERIES
from tests.compare import difference, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 1500
    assert "transaction_category" in df.columns


def test_every_check_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.queries())


def test_registry_needs_no_optional_part(tmp_path):
    """A copy of the repository without the optional subpackage still offers every other query."""
    shutil.copytree(os.path.join(ROOT, "deedmill"), tmp_path / "deedmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], out.stderr
