"""Registered queries against their SQL, over whole tables."""

import pytest
from oracle import compare, connect

from metricloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_its_sql(spark, name):
    ours, theirs, columns, sql_columns = compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF)
    assert columns == sql_columns
    assert not ours and not theirs
