from __future__ import annotations

import pytest
from conftest import SMALL

from __spark_entry__ import entry
from checks.compare import compare_all
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def compared(spark):
    return dict(compare_all(spark, SMALL, QUERIES))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(compared, name):
    assert compared[name] == []
