"""Every registered query against its DuckDB oracle (the driver does the same at sf0.01)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["usage_date", "service_name", "daily_cost", "record_count"]


def test_every_query_has_an_oracle():
    from costlake.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, {name})[name]
    assert res["cols"] and res["spark_rows"] == res["oracle_rows"] and res["exact"], res
