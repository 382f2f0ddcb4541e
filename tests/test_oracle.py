"""Every query of the engine against its SQL, on the smallest tables."""

import pytest

from compare import compare, tables_of
from corvidex.plans import registry


@pytest.fixture(scope="module")
def con(base):
    return tables_of(base)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_sql(spark, con, base, name):
    assert compare(spark, con, registry.QUERIES[name], registry.ORACLE[name], base) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, base, name):
    df = registry.QUERIES[name](spark, base)
    assert len(df.columns) == len(set(df.columns))
    df.count()


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.entry(spark).columns) == {"query_id", "doc_id", "score", "rank"}
