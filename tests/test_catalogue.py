"""Every registered query runs, and equals its SQL where it has one."""

import pytest

import oracle
from evenkeel.catalogue import AREAS, ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_query_names_what_it_covers():
    assert set(AREAS) == set(QUERIES) and all(AREAS.values())
