from __future__ import annotations

import pytest
from parity import oracle_connection, oracle_rows, spark_rows

from __spark_entry__ import oracle_sql, queries
from eventlake.llm.catalog import QUERIES
from eventlake.llm.oracle import ORACLE_SQL


def test_every_operator_is_registered():
    names = set(queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE_SQL) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    sf = "/root/testdata/sf0.001"
    assert spark_rows(QUERIES[name](spark, sf)) == oracle_rows(oracle_connection(sf), ORACLE_SQL[name])
