"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checks.compare import WITHOUT_SQL, compare, duck
from checks.oracle import ORACLE
from lotlens.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_only_known_queries_lack_sql():
    assert set(REGISTRY) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(REGISTRY) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, REGISTRY[name], ORACLE.get(name), SF)
    assert ok, note


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_entry_point_works_without_the_text_operators():
    code = (
        "import sys; sys.modules['lotlens.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "from lotlens.plans.catalog import REGISTRY\n"
        "assert set(e.queries()) == set(REGISTRY) and set(e.oracle_sql()) <= set(REGISTRY)"
    )
    root = os.path.dirname(os.path.abspath(entry.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
