import re

import __spark_entry__ as E


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    # Every query of the library proper has its SQL.
    assert {n for n in set(q) - set(s) if not re.match(r"op\d+_|pipeline$", n)} == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "rank" in df.columns
