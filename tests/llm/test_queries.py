import pytest
from compare import connect, differences

from pulseledger.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
