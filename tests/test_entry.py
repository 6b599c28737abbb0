import __spark_entry__ as entry


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["record", "hash", "bad", "op", "run_ts", "additional"]
    assert df.count() > 0
