"""Every registered query against its DuckDB oracle on the smallest tables.

The driver runs the same comparison at sf0.01 (``tests/oracle_compare.py``
does it locally); here sf0.001 keeps the suite quick.
"""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck_connect
from palimpsest.plans.catalog import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    res = compare(spark, con, name, fn, sql, SF_SMALL, limit_sec=600)
    assert res["status"] in ("match", "rows-only"), res


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
