"""P4, D2 (T9, T10, T22), D3 (T11-T16), D4, D7."""
import pytest

from costlake.operators import dims as D
from costlake.sources.usage import normalize_usage
from tests.conftest import rows, usage_df

SALT = "test-salt"
SNAP = ("customer_id long, email string, phone string, first_name string, last_name string, "
        "segment string, created_at string")


def snap(spark, data):
    return spark.createDataFrame([(i, e, p, "F", "L", s, "2025-01-01") for i, e, p, s in data], SNAP)


def test_category_mapping(spark):
    df = spark.createDataFrame([(c,) for c in ["AmazonEC2", "AmazonS3", "AmazonRDS", "AmazonRedshift",
                                                "AWSLambda", "AmazonCloudWatch", "Other1"]], "pc string")
    got = [r[0] for r in df.select(D.service_category("pc")).collect()]
    assert got == ["Compute", "Storage", "Database", "Database", "Serverless", "Monitoring", "Other"]


def test_dim_service_keys_gaps_and_last_seen_overwrite(spark):
    r1 = normalize_usage(usage_df(spark, [("1", "2025-01-05", "AmazonS3", "b", "1"),
                                          ("2", "2025-01-06", "AmazonEC2", "a", "1")]))
    d1 = D.load_dim_service(r1, None, "t1")
    assert rows(d1, "service_key", "product_code", "first_seen_date", "last_seen_date") == [
        (1, "AmazonEC2", "2025-01-06", "2025-01-06"), (2, "AmazonS3", "2025-01-05", "2025-01-05")]
    # late data: earlier date for EC2 and a new service; keys over all + max (gap), first_seen frozen
    r2 = normalize_usage(usage_df(spark, [("3", "2025-01-02", "AmazonEC2", "a", "1"),
                                          ("4", "2025-01-03", "AWSLambda", "z", "1")]))
    d2 = D.load_dim_service(r2, d1, "t2")
    got = rows(d2, "service_key", "product_code", "service_category", "first_seen_date", "last_seen_date",
               "_loaded_at", "_updated_at")
    assert got == [(1, "AmazonEC2", "Compute", "2025-01-06", "2025-01-02", "t1", "t2"),
                   (2, "AmazonS3", "Storage", "2025-01-05", "2025-01-05", "t1", "t1"),
                   (3, "AWSLambda", "Serverless", "2025-01-03", "2025-01-03", "t2", "t2")]
    # over the whole raw table a new service sorting last leaves a gap
    r3 = r1.unionByName(normalize_usage(usage_df(spark, [("5", "2025-01-07", "AmazonVPC", "z", "1")])))
    d3 = D.load_dim_service(r3, d2, "t3")
    assert rows(d3, "service_key", "product_code") == [
        (1, "AmazonEC2"), (2, "AmazonS3"), (3, "AWSLambda"), (6, "AmazonVPC")]


def test_dim_service_null_key_fails(spark):
    r = normalize_usage(usage_df(spark, [("1", "2025-01-05", None, "b", "1")]))
    with pytest.raises(Exception):
        D.load_dim_service(r, None, "t").collect()


def test_scd2_lifecycle(spark):
    v1 = snap(spark, [(1, "a@x.com", "555-000-0001", "premium"), (2, "b@x.com", "555-000-0002", "standard"),
                      (3, "c@x.com", "555-000-0003", "standard")])
    d1 = D.load_dim_customer(None, v1, SALT, "2025-01-01")
    assert rows(d1, "customer_key", "customer_id", "is_current") == [(1, 1, True), (2, 2, True), (3, 3, True)]
    # 1 changes segment, 2 changes e-mail only (ignored, T11), 3 missing (stays current, T12), 4 new
    v2 = snap(spark, [(1, "a@x.com", "555-000-0001", "enterprise"), (2, "bb@x.com", "555-000-0002", "standard"),
                      (4, "d@x.com", "555-000-0004", "premium")])
    d2 = D.load_dim_customer(d1, v2, SALT, "2025-01-15")
    got = rows(d2, "customer_key", "customer_id", "segment", "effective_from", "effective_to", "is_current")
    assert got == [(1, 1, "premium", "2025-01-01", "2025-01-15", False),
                   (2, 2, "standard", "2025-01-01", None, True),
                   (3, 3, "standard", "2025-01-01", None, True),
                   (4, 1, "enterprise", "2025-01-15", None, True),
                   (5, 4, "premium", "2025-01-15", None, True)]
    # idempotent: the same snapshot again changes nothing
    d3 = D.load_dim_customer(d2, v2, SALT, "2025-01-15")
    assert rows(d3) == rows(d2)
    # A -> B -> A gives three versions
    v3 = snap(spark, [(1, "a@x.com", "555-000-0001", "premium")])
    d4 = D.load_dim_customer(d3, v3, SALT, "2025-02-01")
    assert [r[2] for r in rows(d4.filter("customer_id = 1"), "customer_key", "effective_from", "segment")] == [
        "premium", "enterprise", "premium"]
    e = d4.filter("customer_id = 1").collect()
    assert all(len(r.email_token) == 64 and "@" not in r.email_token for r in e)
    assert {r.phone_redacted for r in e} == {"XXX-XXX-0001"}


def test_scd2_same_day_zero_length(spark):
    v1 = snap(spark, [(1, "a@x.com", "555-000-0001", "premium")])
    v2 = snap(spark, [(1, "a@x.com", "555-000-0001", "standard")])
    d = D.load_dim_customer(D.load_dim_customer(None, v1, SALT, "2025-01-10"), v2, SALT, "2025-01-10")
    got = sorted((r.customer_key, r.effective_from, r.effective_to, r.is_current) for r in d.collect())
    assert got == [(1, "2025-01-10", "2025-01-10", False), (2, "2025-01-10", None, True)]


def test_scd2_duplicate_in_snapshot_fails(spark):
    v = snap(spark, [(1, "a@x.com", "555-000-0001", "premium"), (1, "a@x.com", "555-000-0001", "premium")])
    with pytest.raises(Exception, match="duplicate key in customer snapshot"):
        D.load_dim_customer(None, v, SALT, "2025-01-01").collect()


def test_mask_strict_and_quarantine(spark):
    v = snap(spark, [(1, "a@x.com", "555-000-0001", "premium"), (2, "bad", "555-000-0002", "premium"),
                     (3, "c@x.com", "12", "premium"), (4, "d@x.com", "555-000-0004", None)])
    with pytest.raises(Exception, match="invalid customer row"):
        D.mask_snapshot(v, SALT).collect()
    q = D.mask_snapshot_quarantine(v, SALT)
    assert [r.customer_id for r in q.valid.collect()] == [1]
    assert rows(q.rejected) == [(2, "invalid email"), (3, "phone too short"), (4, "NULL segment")]
    with pytest.raises(ValueError):
        D.mask_snapshot(v, "")


def test_snapshot_diff(spark):
    v1 = snap(spark, [(1, "a@x", "1111", "p"), (2, "b@x", "2222", "s"), (3, "c@x", "3333", "s"),
                      (5, "e@x", "5555", "s")])
    v2 = snap(spark, [(1, "a@x", "1111", "e"), (2, "b@x", "2229", "s"), (3, "c@x", "3333", "s"),
                      (4, "d@x", "4444", "p")])
    got = rows(D.snapshot_diff(v1, v2), "customer_id", "change_type")
    assert got == [(1, "segment_changed"), (2, "contact_changed"), (3, "unchanged"), (4, "new"), (5, "removed")]


def test_snapshot_diff_duplicate_id_fails(spark):
    v1 = snap(spark, [(1, "a@x", "1111", "p"), (1, "a@x", "1111", "p")])
    v2 = snap(spark, [(1, "a@x", "1111", "p")])
    with pytest.raises(Exception, match="duplicate key in old snapshot"):
        D.snapshot_diff(v1, v2).collect()
