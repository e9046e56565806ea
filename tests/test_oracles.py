"""Every registered query gives the rows of its SQL oracle."""

import pytest
from compare import compare, connect

from tidemark.workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir) is None
