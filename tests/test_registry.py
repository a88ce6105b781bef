"""Every registered query against its check SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest
from compare import connect
from compare import rows as bag

import __spark_entry__ as entry
from caseworks.workload import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_check_sql(spark, con, name):
    df = registry.queries()[name](spark, SF_DIR)
    cursor = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(names, cursor.fetchall())


def test_every_query_has_check_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
