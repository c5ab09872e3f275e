import pytest

from tests.compare import connection, same
from ticketloom.plans import registry


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, sf, con, name):
    same(registry.QUERIES[name](spark, sf), con, registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_replies_hold_whole_texts(spark, sf):
    from ticketloom.plans import queries_text

    assert queries_text._replies(spark, sf).filter("ord % 7 = 0 AND ord % 9 <> 8 AND length(reply) > 1000").count() > 0
