"""Every registered query at the smallest scale: against its SQL, or for rows where there is none."""

from __future__ import annotations

import __spark_entry__ as entry
import compare
import pytest

SF = "/root/testdata/sf0.001"
ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))
# models need more hours than the smallest scale has
MODELS_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_model_queries_return_rows(spark, name):
    assert entry.queries()[name](spark, MODELS_SF).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
