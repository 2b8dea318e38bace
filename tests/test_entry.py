import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 14
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    from chainyard.testing import queries as Q
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data operators are held against brute force in tests of their own
    assert not set(Q.QUERIES) - set(o), f"queries without oracle: {set(Q.QUERIES) - set(o)}"
