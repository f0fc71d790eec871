"""Each query against its SQL, and the smoke entry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import difference
from checks.duck_sql import statements


@pytest.mark.parametrize("name", sorted(statements()))
def test_equals_sql(spark, duck, small, name):
    assert difference(spark, duck, small, name) is None


def test_every_query_has_sql():
    assert set(entry._JOBS) == set(statements())


def test_entry(spark):
    assert entry.entry(spark).count() == 1442
