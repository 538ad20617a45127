"""Daily cost summary and the analytics on top of it.

A1 ``daily_cost_summary``, W1 ``compute_trend``, A5/O1 ``top_services_by_cost``,
A6/W2 ``month_over_month_change``, A6/W3 ``detect_cost_anomalies``.

The summary is one row per (date, service), so everything after it runs on
a frame whose size is dates x services, independent of the raw volume. Its
money column stays DECIMAL(38,6); cast to double at the output edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.dates import month_key, week_key
from costlake.functions.money import cost_or_zero, pct_change
from costlake.schemas import MONEY_SUM


def daily_cost_summary(raw: DataFrame) -> DataFrame:
    """A1: SUM(cost) and COUNT(*) per (usage_date, service_name).

    NULL cost counts as 0; sums are exact and not rounded. Group keys keep
    their text form (a NULL key forms its own group). Partial aggregation
    runs before the shuffle, so the exchange carries one row per
    (date, service) per task. Not sorted: order at the edge.
    """
    return (
        raw.select(
            F.col("line_item_usage_start_date").alias("usage_date"),
            F.col("line_item_product_code").alias("service_name"),
            cost_or_zero("line_item_unblended_cost").alias("cost"),
        )
        .groupBy("usage_date", "service_name")
        .agg(F.sum("cost").cast(MONEY_SUM).alias("daily_cost"),
             F.count(F.lit(1)).alias("record_count"))
    )


def compute_trend(summary: DataFrame, window: int = 7) -> DataFrame:
    """Mean of ``daily_cost`` over the last ``window`` rows per service.

    The frame is ``window`` *rows* (gaps in dates stretch it); the mean is
    NULL until ``window`` rows exist. The output column is always
    ``cost_7d_avg``. The mean is the exact decimal sum divided as double.
    """
    if window < 1:
        raise ValueError("window must be >= 1")
    w = (Window.partitionBy("service_name").orderBy("usage_date")
         .rowsBetween(-(window - 1), Window.currentRow))
    n = F.count(F.lit(1)).over(w)
    s = F.sum("daily_cost").over(w).cast("double")
    return summary.withColumn(
        "cost_7d_avg", F.when(n == window, s / F.lit(float(window))))


def service_totals(summary: DataFrame) -> DataFrame:
    """A5: total cost per service (a sum over only NULLs is 0)."""
    return summary.groupBy("service_name").agg(
        F.coalesce(F.sum("daily_cost"), F.lit(0)).cast(MONEY_SUM).alias("total_cost"))


def top_services_by_cost(summary: DataFrame, n: int = 10) -> DataFrame:
    """O1: the ``n`` services with the highest total cost, ties by name.

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those reach the final merge.
    """
    return (service_totals(summary)
            .orderBy(F.col("total_cost").desc(), F.col("service_name").asc())
            .limit(n))


def monthly_cost(summary: DataFrame) -> DataFrame:
    """Cost per (service, month), month = first 7 characters of the date."""
    return (summary.withColumn("month", month_key("usage_date"))
            .groupBy("service_name", "month")
            .agg(F.sum("daily_cost").cast(MONEY_SUM).alias("monthly_cost")))


def weekly_cost(summary: DataFrame) -> DataFrame:
    """Cost per (service, week), week = ``%Y-W%W`` of the strict date."""
    return (summary.withColumn("week", week_key("usage_date"))
            .groupBy("service_name", "week")
            .agg(F.sum("daily_cost").cast(MONEY_SUM).alias("weekly_cost")))


def month_over_month_change(summary: DataFrame) -> DataFrame:
    """Change against the previous *observed* month of the same service;
    the first month of each service has NULL ``pct_change``."""
    m = monthly_cost(summary)
    prev = F.lag("monthly_cost", 1).over(Window.partitionBy("service_name").orderBy("month"))
    return m.withColumn("pct_change", pct_change(F.col("monthly_cost"), prev))


def detect_cost_anomalies(summary: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Weeks whose cost rose more than ``threshold`` over the previous
    observed week of the same service.

    Output: service_name, week, weekly_cost, prev_weekly_cost, pct_change.
    A zero previous week gives +inf/NaN and is flagged (float rules).
    """
    wk = weekly_cost(summary)
    prev = F.lag("weekly_cost", 1).over(Window.partitionBy("service_name").orderBy("week"))
    with_change = (wk.withColumn("prev_weekly_cost", prev)
                   .withColumn("pct_change", pct_change(F.col("weekly_cost"), F.col("prev_weekly_cost"))))
    return (with_change.filter(F.col("pct_change") > F.lit(float(threshold)))
            .select("service_name", "week", "weekly_cost", "prev_weekly_cost", "pct_change"))


def summary_metrics(summary: DataFrame) -> dict:
    """A13 for the summary step: rows, distinct dates and distinct services
    (one aggregation job over the small summary frame)."""
    r = summary.agg(F.count(F.lit(1)).alias("rows"),
                    F.countDistinct("usage_date").alias("dates"),
                    F.countDistinct("service_name").alias("services")).first()
    return {"rows": int(r["rows"]), "dates": int(r["dates"]), "services": int(r["services"])}
