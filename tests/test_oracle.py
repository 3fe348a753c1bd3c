"""Every registered query against its DuckDB oracle (the driver's correctness gate), on the
smallest source folder by default (``TEST_SF_DIR`` to change)."""

import pytest

from helpers import SF_SMALL
from oracle_check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

#: The operators for training text have tests of their own.
NAMES = sorted(n for n in queries() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sqls = oracle_sql()
    fn = queries()[name]
    if name not in sqls:
        fn(spark, SF_SMALL).collect()  # counting would let Spark skip a failing column
        return
    r = compare(spark, con, name, SF_SMALL, fn, sqls[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "orders", "total_qty", "total_sales", "total_profit", "profit_margin_pct"]


def test_registry_has_oracle_for_almost_all():
    missing = set(NAMES) - set(oracle_sql())
    assert missing == set()
