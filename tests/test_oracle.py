"""Registered queries against their SQL on the smallest driver tables."""

import os

import pytest

from checks.compare import DATA, compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", QUERIES)
def test_agrees(spark, db, name):
    assert compare(name, spark, SF_DIR, db) == ""
