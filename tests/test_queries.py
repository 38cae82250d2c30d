"""Every query of the engine against its SQL on the smallest tables."""

import pytest
from oracle import check

from tidemark.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, sf, name):
    check(spark, sf, QUERIES[name], SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_point_imports_and_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_the_subpackage_imports_it():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "tidemark"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "tidemark.llm" not in p.read_text(), p
