"""Every registered query against its SQL text on the smallest tables."""

import os

import pytest

from testbed import all_queries
from testbed.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, TEXTS = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in TEXTS:
        assert compare(df, tables.sql(TEXTS[name])) == ""
    else:
        assert df.count() > 0


def test_only_the_trained_model_has_no_sql():
    assert set(QUERIES) - set(TEXTS) == {"module_scoring"}
    assert set(TEXTS) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(TEXTS) <= set(entry.oracle_sql())
