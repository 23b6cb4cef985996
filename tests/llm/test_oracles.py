"""Queries of the training-data operators next to their DuckDB SQL, and all of them on the smallest tables."""

import pytest

from payscope.llm.queries import QUERIES, SQL
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    result = compare(spark, duck(SF), name, SF, QUERIES, SQL)
    assert result["status"] == "ok", result


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
