import importlib


def test_entry_and_registry(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 56 and rows and set(df.columns) >= {"rank", "term", "binary"}
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
