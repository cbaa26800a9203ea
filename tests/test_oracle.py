"""Every registered query against its SQL on the smallest tables."""

import importlib.util
import os

import pytest

from rillflow.queries import all_queries

from . import oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    # A threshold query may find nothing in the smallest tables.
    assert oracle.compare(spark, con, SF_DIR, QUERIES[name], allow_empty=True) is None


def test_driver_contract(spark):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(root, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
