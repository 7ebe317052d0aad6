"""Every registered query against its check SQL, on the smallest tables."""

import pytest

from suite import check, registry


EMPTY_BY_DESIGN: set[str] = set()
"""Queries whose result may be empty on the smallest tables."""


@pytest.fixture(scope="module")
def con(small):
    return check.connect(small)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, small, name):
    result = check.compare(spark, con, small, registry.queries()[name], registry.oracles().get(name))
    assert result.startswith(("ok", "rows")), result
    assert name in EMPTY_BY_DESIGN or not result.endswith((" EMPTY", "rows=0")), result


def test_entry_points(spark):
    entry = check.load_entry()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 25
