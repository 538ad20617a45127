"""J1-J4, A2, A4, A7, A8, D5, D6 (T7, T8, T17, T18) with brute-force references."""
import datetime as dt
import random
from decimal import Decimal

from costlake.operators import facts as FA
from costlake.sources.usage import normalize_usage
from tests.conftest import rows, usage_df

DIMC = ("customer_key long, customer_id long, email_token string, phone_redacted string, first_name string, "
        "last_name string, segment string, effective_from string, effective_to string, is_current boolean, "
        "_loaded_at string")
DIMS = ("service_key long, product_code string, usage_type string, service_category string, "
        "first_seen_date string, last_seen_date string, _loaded_at string, _updated_at string")


def dim_service(spark, data):
    return spark.createDataFrame([(k, p, u, "Other", "d", "d", "t", "t") for k, p, u in data], DIMS)


def dim_customer(spark, versions):
    return spark.createDataFrame(
        [(k, cid, "t" * 64, "XXX-XXX-0000", "F", "L", seg, f, t, t is None, f) for k, cid, seg, f, t in versions], DIMC)


def test_service_daily_join_drops_unknown_and_null(spark):
    raw = normalize_usage(usage_df(spark, [
        ("1", "2025-01-01", "EC2", "a", "1.005"), ("2", "2025-01-01", "EC2", "a", None),
        ("3", "2025-01-01", "EC2", "zzz", "5"), ("4", "2025-01-01", None, "a", "5")]))
    sd = FA.service_daily(raw, dim_service(spark, [(7, "EC2", "a")]))
    assert rows(sd) == [("2025-01-01", 7, Decimal("1.01"), 2, 1)]


def test_fact_daily_upsert_keeps_old_dates(spark):
    ds = dim_service(spark, [(1, "EC2", "a")])
    r1 = normalize_usage(usage_df(spark, [("1", "2025-01-01", "EC2", "a", "1"), ("2", "2025-01-02", "EC2", "a", "2")]))
    f1 = FA.load_fact_daily_cost(r1, ds, None, "run1")
    r2 = normalize_usage(usage_df(spark, [("3", "2025-01-02", "EC2", "a", "5")]))
    got = rows(FA.load_fact_daily_cost(r2, ds, f1, "run2"), "usage_date", "daily_cost", "_loaded_at")
    assert got == [("2025-01-01", Decimal("1.00"), "run1"), ("2025-01-02", Decimal("5.00"), "run2")]
    part = rows(FA.load_fact_daily_cost(r2, ds, f1, "run2", partitions_only=True), "usage_date")
    assert part == [("2025-01-02",)]


def _rand_versions(rng, n):
    base = dt.date(2025, 1, 1)
    out, key = [], 0
    for cid in range(n):
        start = rng.randint(-10, 25)
        for _ in range(rng.randint(1, 3)):
            key += 1
            length = rng.choice([0, 1, 3, 10, None])
            f = base + dt.timedelta(days=start)
            t = None if length is None else f + dt.timedelta(days=length)
            out.append((key, cid, rng.choice("ABC"), f.isoformat(), None if t is None else t.isoformat()))
            if t is None:
                break
            start += length
    return out


def test_active_counts_and_pairs_match_brute_force(spark):
    rng = random.Random(5)
    versions = _rand_versions(rng, 60)
    dates = sorted({(dt.date(2025, 1, 1) + dt.timedelta(days=rng.randint(0, 30))).isoformat() for _ in range(20)})
    dc = dim_customer(spark, versions)
    dd = spark.createDataFrame([(d,) for d in dates], "usage_date string")

    def active(d):
        return [k for k, _, _, f, t in versions if f <= d < (t or "9999-12-31")]
    want_pairs = sorted((d, k) for d in dates for k in active(d))
    want_counts = sorted((d, len(active(d))) for d in dates if active(d))
    assert rows(FA.active_pairs(dc, dd), "usage_date", "customer_key") == want_pairs
    assert rows(FA.active_customers_per_date(dc, dd)) == want_counts


def test_pairs_of_date_texts_with_time_and_of_dates_years_apart(spark):
    dc = dim_customer(spark, [(1, 1, "A", "2023-01-01", "2025-01-02"), (2, 1, "A", "2025-01-02", None)])
    dd = spark.createDataFrame([("2023-01-01T00:00:00Z",), ("2025-01-01",), ("2025-01-02T05:00:00Z",), (None,)],
                               "usage_date string")
    want = [("2023-01-01T00:00:00Z", 1), ("2025-01-01", 1), ("2025-01-02T05:00:00Z", 2)]
    assert rows(FA.active_pairs(dc, dd), "usage_date", "customer_key") == want
    assert rows(FA.active_customers_per_date(dc, dd.filter("usage_date IS NOT NULL"))) == [(d, 1) for d, _ in want]
    assert rows(FA.active_pairs(dc, dd.limit(0)), "usage_date", "customer_key") == []


def test_customer_cost_allocation(spark):
    raw = normalize_usage(usage_df(spark, [
        ("1", "2025-01-01", "EC2", "a", "1.16"), ("2", "2025-01-01", "S3", "b", None),
        ("3", "2025-01-02", "EC2", "a", "10.00"), ("4", "2025-01-03", "EC2", "a", "3.00")]))
    ds = dim_service(spark, [(1, "EC2", "a"), (2, "S3", "b")])
    # 8 customers on 01-01 and 01-02, none on 01-03 (that day vanishes)
    versions = [(k, k, "A", "2025-01-01", "2025-01-03") for k in range(1, 9)]
    dc = dim_customer(spark, versions)
    f = FA.customer_cost(raw, ds, dc, "t")
    got = rows(f, "usage_date", "service_key", "allocated_cost", "record_count", "null_cost_count")
    assert len(got) == 8 * 3
    assert set(got) == {("2025-01-01", 1, Decimal("0.15"), 1, 0), ("2025-01-01", 2, Decimal("0.00"), 1, 1),
                        ("2025-01-02", 1, Decimal("1.25"), 1, 0)}
    seg = rows(FA.segment_cost(f, dc))
    assert seg == [("A", Decimal("11.20"))]
    assert rows(FA.distinct_customers_per_date(f)) == [("2025-01-01", 8), ("2025-01-02", 8)]


def test_customer_cost_salted_path_equals_broadcast(spark):
    raw = normalize_usage(usage_df(spark, [(str(i), f"2025-01-0{1 + i % 5}", "EC2", "a", f"{i}.37") for i in range(40)]))
    ds = dim_service(spark, [(1, "EC2", "a")])
    dc = dim_customer(spark, [(k, k, "A", "2025-01-01", None) for k in range(1, 50)])
    a = rows(FA.customer_cost(raw, ds, dc, "t"))
    spark.conf.set("costlake.broadcast.maxRows", "0")
    try:
        b = rows(FA.customer_cost(raw, ds, dc, "t"))
    finally:
        spark.conf.unset("costlake.broadcast.maxRows")
    assert a == b and len(a) == 5 * 49


def test_enrich_daily_fact(spark):
    f = spark.createDataFrame([("2025-01-01", 1, Decimal("2.00"), 1, 0, "t")],
                              "usage_date string, service_key long, daily_cost decimal(38,2), record_count long, "
                              "null_cost_count long, _loaded_at string")
    e = FA.enrich_daily_fact(f, dim_service(spark, [(1, "EC2", "a"), (2, "S3", "b")]))
    assert rows(e, "usage_date", "product_code", "usage_type") == [("2025-01-01", "EC2", "a")]
