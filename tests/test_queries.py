"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import compare, duck
from weirworks.plans import ORACLES, QUERIES

SQL = ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    verdict = compare(df, con, SQL[name])
    assert verdict.startswith("OK"), verdict


def test_flagship(spark):
    assert entry.entry(spark).columns == ["window_end", "item_id", "view_count", "rank"]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
