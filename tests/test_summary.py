"""A1, W1, A5/O1, A6/W2, W3 on hand-made usage lines (traps T3-T6, T23)."""
import math

from costlake.operators import summary as S
from costlake.sources.usage import normalize_usage
from tests.conftest import rows, usage_df


def _summary(spark, lines):
    return S.daily_cost_summary(normalize_usage(usage_df(spark, lines)))


def test_daily_summary_null_cost_and_counts(spark):
    s = _summary(spark, [("1", "2025-01-01", "EC2", "a", "1.10"), ("2", "2025-01-01", "EC2", "b", None),
                         ("3", "2025-01-01", "S3", "a", "2.005"), ("4", "2025-01-02", "EC2", "a", "-1.00")])
    got = rows(s)
    assert [(d, sv, float(c), n) for d, sv, c, n in got] == [
        ("2025-01-01", "EC2", 1.10, 2), ("2025-01-01", "S3", 2.005, 1), ("2025-01-02", "EC2", -1.0, 1)]


def test_daily_summary_empty_keeps_schema(spark):
    s = S.daily_cost_summary(normalize_usage(usage_df(spark, [])))
    assert s.columns == ["usage_date", "service_name", "daily_cost", "record_count"] and s.count() == 0


def test_daily_summary_null_key_forms_group(spark):
    s = _summary(spark, [("1", "2025-01-01", None, "a", "1.00"), ("2", "2025-01-01", None, "a", "2.00")])
    assert [(r[1], float(r[2])) for r in rows(s)] == [(None, 3.0)]


def test_trend_rows_not_days(spark):
    # 8 observed days with a gap: the window is 7 rows, not 7 calendar days
    days = ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-05", "2025-01-06", "2025-01-08", "2025-01-09",
            "2025-01-10"]
    lines = [(str(i), d, "EC2", "a", f"{i + 1}.00") for i, d in enumerate(days)]
    t = S.compute_trend(_summary(spark, lines), 7)
    got = [r.cost_7d_avg for r in t.orderBy("usage_date").collect()]
    assert got[:6] == [None] * 6
    assert got[6] == (1 + 2 + 3 + 4 + 5 + 6 + 7) / 7 and got[7] == (2 + 3 + 4 + 5 + 6 + 7 + 8) / 7
    assert "cost_7d_avg" in S.compute_trend(_summary(spark, lines), 3).columns


def test_top_services_tie_break_and_limit(spark):
    lines = [("1", "2025-01-01", "B", "a", "5.00"), ("2", "2025-01-01", "A", "a", "5.00"),
             ("3", "2025-01-01", "C", "a", "9.00"), ("4", "2025-01-01", "D", "a", None)]
    got = [(r.service_name, float(r.total_cost)) for r in S.top_services_by_cost(_summary(spark, lines), 3).collect()]
    assert got == [("C", 9.0), ("A", 5.0), ("B", 5.0)]
    d = [(r.service_name, float(r.total_cost)) for r in S.top_services_by_cost(_summary(spark, lines), 10).collect()]
    assert d[-1] == ("D", 0.0)


def test_month_over_month_values(spark):
    lines = [("1", "2025-01-05", "EC2", "a", "10.00"), ("2", "2025-02-05", "EC2", "a", "15.00"),
             ("3", "2025-04-05", "EC2", "a", "12.00"), ("4", "2025-02-01", "S3", "a", "3.00")]
    m = S.month_over_month_change(_summary(spark, lines))
    got = {(r.service_name, r.month): r.pct_change for r in m.collect()}
    # previous observed month, not the adjacent calendar month (T4)
    assert got == {("EC2", "2025-01"): None, ("EC2", "2025-02"): 0.5, ("EC2", "2025-04"): -0.2,
                   ("S3", "2025-02"): None}


def test_anomalies_threshold_zero_prev_and_year_boundary(spark):
    lines = [("1", "2024-12-30", "EC2", "a", "10.00"), ("2", "2025-01-01", "EC2", "a", "13.00"),
             ("3", "2025-01-06", "EC2", "a", "14.00"),
             ("4", "2025-01-01", "S3", "a", "0.00"), ("5", "2025-01-06", "S3", "a", "0.00"),
             ("6", "2025-01-13", "S3", "a", "5.00"), ("7", "2025-01-20", "S3", "a", "5.00")]
    a = S.detect_cost_anomalies(_summary(spark, lines), 0.20)
    got = {(r.service_name, r.week): r.pct_change for r in a.collect()}
    assert a.columns == ["service_name", "week", "weekly_cost", "prev_weekly_cost", "pct_change"]
    # 2024-W53 -> 2025-W00 +30 % (T5); W00 -> W01 +7.7 % not flagged
    assert got[("EC2", "2025-W00")] == 0.3 and ("EC2", "2025-W01") not in got
    # 0 -> 0 is NaN and flagged, 0 -> 5 is +inf (T6); 5 -> 5 is not
    assert math.isnan(got[("S3", "2025-W01")]) and got[("S3", "2025-W02")] == math.inf
    assert ("S3", "2025-W03") not in got


def test_summary_metrics(spark):
    s = _summary(spark, [("1", "2025-01-01", "EC2", "a", "1"), ("2", "2025-01-02", "EC2", "a", "1"),
                         ("3", "2025-01-02", "S3", "a", "1")])
    assert S.summary_metrics(s) == {"rows": 3, "dates": 2, "services": 2}
