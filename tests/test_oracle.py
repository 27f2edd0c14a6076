"""Every registered query against its SQL on the smallest data; model queries must return rows."""

import pytest

from clientele.plans import ORACLE, QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, FOLDER), ORACLE[name]) in (None, "EMPTY (equal)")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_verified_questions_are_registered():
    from clientele.plans.verified import VERIFIED

    assert set(VERIFIED.values()) <= set(QUERIES)


def test_entry_gives_rows(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert rows and abs(sum(r["percentage"] for r in rows) - 100) < 0.1
