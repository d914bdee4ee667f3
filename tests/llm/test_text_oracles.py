"""Text queries with an oracle match it at sf0.01."""

import pytest
from conftest import SF001
from oracle_compare import compare, duck

from tapewise.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    ok, msg = compare(spark, duck(SF001), name, QUERIES[name], ORACLES[name], SF001)
    assert ok, msg
