import pytest
from gridloom import queries as core
from rows import SF, normal


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_matches_sql(name, spark, duck):
    found = core.QUERIES[name](spark, SF).toPandas()
    assert len(found)
    if name in core.ORACLE_SQL:
        assert normal(found) == normal(duck.execute(core.ORACLE_SQL[name]).df())


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
