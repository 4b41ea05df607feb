"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("MILLRACE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, TWINS[name]) is None


def test_rows_only_queries_run(spark):
    for name in QUERIES.keys() - TWINS.keys():
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_ivf_recall_is_useful(spark):
    recall = QUERIES["knn_ivf_recall"](spark, FOLDER).agg({"recall": "avg"}).first()[0]
    assert 0.9 <= recall <= 1.0
