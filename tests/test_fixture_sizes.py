"""View sizes at sf0.001 as listed in FIXTURES.md (computed there with DuckDB)."""
from pyspark.sql import functions as F

from costlake.operators import summary as S
from costlake.plans.queries import QUERIES, raw_usage, raw_usage_long
from tests.conftest import SF_SMALL


def test_usage_view_sizes(spark):
    raw = raw_usage(spark, SF_SMALL)
    r = raw.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("line_item_unblended_cost").isNull()).alias("nulls")).first()
    assert (r.n, r.nulls) == (1000, 20)
    assert QUERIES["daily_cost_summary"](spark, SF_SMALL).count() == 150
    assert QUERIES["dim_service"](spark, SF_SMALL).count() == 15


def test_warehouse_sizes(spark):
    assert QUERIES["fact_daily_cost"](spark, SF_SMALL).count() == 411
    dc = QUERIES["dim_customer_scd2"](spark, SF_SMALL)
    assert dc.count() == 170 and dc.filter("is_current").count() == 150
    assert QUERIES["fact_customer_cost"](spark, SF_SMALL).count() == 60292


def test_long_view_analytics_sizes(spark):
    summary = S.daily_cost_summary(raw_usage_long(spark, SF_SMALL))
    assert S.monthly_cost(summary).count() == 497
    assert S.detect_cost_anomalies(summary, 0.20).count() == 869
    assert S.detect_cost_anomalies(S.daily_cost_summary(raw_usage(spark, SF_SMALL)), 0.20).count() == 3
