"""Every registered query with an oracle gives the oracle's rows, names and values."""

import pytest

from __spark_entry__ import oracle_sql, queries
from checks.compare import differences, oracle_connection
from tests.conftest import SMALL

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, con, name):
    assert differences(spark, con, name, queries()[name], ORACLES[name], SMALL) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())
