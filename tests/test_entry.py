import __spark_entry__ as entry_module


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
