import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_contract_keys():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 30


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert len(df.columns) == 17 and df.count() > 0
