"""Every query of the core that has SQL, against DuckDB; the others give rows."""

import pytest

from landchange.plans import areas, engine, pages, problems
from tests.compare import connect, same

QUERIES = engine.QUERIES | areas.QUERIES | pages.QUERIES | problems.QUERIES
ORACLE = engine.ORACLE | areas.ORACLE | pages.ORACLE | problems.ORACLE


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, data, con, name):
    same(QUERIES[name](spark, data), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"leave_one_region_out"}))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
