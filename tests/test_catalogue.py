"""Every registered query against its SQL check."""

import pytest
from compare import connect, differences

from pulseledger.catalogue.oracle import ORACLE
from pulseledger.catalogue.queries import QUERIES
from pulseledger.session import scratch


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, connection):
    assert connection.execute(f"SELECT count(*) FROM ({ORACLE[name]})").fetchone()[0] > 0
    with scratch(spark):
        assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == []
