"""What holds for all queries: empty tables, and a row for each row of documents."""

import pytest

from riskpipe.llm.queries import ORACLE, QUERIES

from .conftest import run


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_empty_results(spark, empty_tables, name):
    assert run(spark, name, empty_tables) == []
