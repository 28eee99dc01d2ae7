"""Every query that has a DuckDB twin gives the same rows."""

from __future__ import annotations

import pytest

import geoloom.plans  # noqa: F401
from geoloom.plans.registry import QUERIES, SQL

from .duck import connect, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"so10_simplified"}))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
