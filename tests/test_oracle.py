"""Every query with an SQL oracle must match DuckDB on the same tables (sf0.001 here; the driver uses sf0.01)."""
import pytest

from quarry.plans import REGISTRY
from tests.conftest import SF_SMALL
from tests.oracle import compare

SQL_QUERIES = sorted(k for k, q in REGISTRY.items() if q.sql)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_matches_sql(spark, duck, name):
    q = REGISTRY[name]
    problems = compare(spark, name, q.fn, q.sql, SF_SMALL, duck, verbose=False)
    assert not problems, problems


def test_entry_runs(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.columns == ["user_id", "total", "mean_plays"]
    assert len(df.collect()) == 3
    assert set(ent.oracle_sql()) <= set(ent.queries())
