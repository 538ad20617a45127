"""Q1-Q9."""
import json
import os
from decimal import Decimal

from costlake.operators import quality as QA
from costlake.sources.usage import read_ledger
from tests.conftest import rows
from tests.test_facts import dim_customer, dim_service

FC = ("usage_date string, customer_key long, service_key long, allocated_cost decimal(38,2), record_count long, "
      "null_cost_count long, _loaded_at string")
FD = ("usage_date string, service_key long, daily_cost decimal(38,2), record_count long, null_cost_count long, "
      "_loaded_at string")


def as_dict(df):
    return {r.check_name: r.violations for r in df.collect()}


def test_orphans_and_grain(spark):
    fc = spark.createDataFrame([("d", 1, 1, Decimal("1"), 1, 0, "t"), ("d", 9, 1, Decimal("1"), 1, 0, "t"),
                                ("d", 9, 1, Decimal("1"), 1, 0, "t")], FC)
    fd = spark.createDataFrame([("d", 5, Decimal("1"), 1, 0, "t")], FD)
    dc = dim_customer(spark, [(1, 1, "A", "2025-01-01", None)])
    ds = dim_service(spark, [(1, "EC2", "a")])
    got = as_dict(QA.referential_integrity(fc, fd, dc, ds))
    assert got == {"fact_customer_cost.customer_key": 2, "fact_customer_cost.service_key": 0,
                   "fact_daily_cost.service_key": 1}
    g = QA.grain_check(fc, ["usage_date", "customer_key", "service_key"], "fc").first()
    assert (g.row_count, g.distinct_keys, g.duplicate_keys) == (3, 2, 1)
    assert rows(QA.duplicate_keys(fc, ["customer_key"])) == [(9, 2)]


def test_reconcile(spark):
    fd = spark.createDataFrame([("d", 1, Decimal("1.00"), 3, 0, "t")], FD)
    raw = spark.createDataFrame([(str(i),) for i in range(5)], "identity_line_item_id string")
    r = QA.reconcile_counts(fd, raw).first()
    assert (r.fact_records, r.raw_rows, r.unmatched) == (3, 5, 2)
    fc = spark.createDataFrame([("d", k, 1, Decimal("0.33"), 3, 0, "t") for k in range(3)], FC)
    c = QA.reconcile_cost(fc, fd).first()
    assert c.allocated_total == Decimal("0.99") and c.customers == 3 and c.within_tolerance
    fc2 = spark.createDataFrame([("d", k, 1, Decimal("0.30"), 3, 0, "t") for k in range(3)], FC)
    assert not QA.reconcile_cost(fc2, fd).first().within_tolerance


def test_scd2_integrity(spark):
    good = dim_customer(spark, [(1, 1, "A", "2025-01-01", "2025-01-10"), (2, 1, "B", "2025-01-10", None)])
    assert set(as_dict(QA.scd2_integrity(good)).values()) == {0}
    bad = dim_customer(spark, [(1, 1, "A", "2025-01-01", None), (2, 1, "B", "2025-01-10", None),
                               (3, 2, "A", "2025-01-05", "2025-01-01"), (3, 3, "A", "2025-01-01", None)])
    got = as_dict(QA.scd2_integrity(bad))
    assert got["multiple_current"] == 1 and got["overlapping_versions"] == 1
    assert got["end_before_start"] == 1 and got["no_current"] == 1 and got["duplicate_customer_key"] == 1


def test_cost_ranges(spark):
    fd = spark.createDataFrame([("d", 1, Decimal("-1.00"), 0, 0, "t"), ("", None, Decimal("1.00"), 1, 0, "t")], FD)
    got = as_dict(QA.cost_range_checks(fd, "daily_cost"))
    assert got["negative_cost"] == 1 and got["non_positive_record_count"] == 1
    assert got["null_service_key"] == 1 and got["empty_usage_date"] == 1 and got["null_cost"] == 0


def test_pii_leak(spark):
    dc = dim_customer(spark, [(1, 1, "A", "2025-01-01", None)])
    fd = spark.createDataFrame([], FD).withColumnRenamed("_loaded_at", "email")
    got = as_dict(QA.pii_leak_check(dc, fd))
    assert got["email_token_not_sha256_hex"] == 1 and got["pii_column_in_fact"] == 1
    assert got["email_token_has_at"] == 0 and got["phone_not_redacted"] == 0


def _ledger(spark, tmp_root, entries):
    p = os.path.join(tmp_root, "ledger.jsonl")
    with open(p, "w") as f:
        for e in entries:
            f.write(json.dumps(e) + "\n")
    return read_ledger(spark, p)


def test_gate_and_overrides(spark, tmp_root):
    led = _ledger(spark, tmp_root, [
        {"evidence_id": "E1", "control_id": "C-04", "status": "pass"},
        {"evidence_id": "E2", "control_id": "C-04", "status": "pass"},
        {"evidence_id": "E3", "control_id": "C-05", "status": "fail"},
        {"evidence_id": "O1", "control_id": "C-11", "status": "pass", "remediation_status": "completed"},
        {"evidence_id": "O2", "control_id": "C-11", "status": "pass", "remediation_status": "escalated",
         "standard_controls_deferred": ["C-06", "C-06", "C-07"], "remediation_deadline": "2025-02-01"},
        {"evidence_id": "O3", "control_id": "C-04", "status": "fail", "standard_controls_deferred": ["C-07"]},
    ])
    req = spark.createDataFrame([("C-04",), ("C-05",)], "control_id string")
    cov = {r.control_id: (r.status, r.evidence_count, r.gate_result) for r in QA.control_coverage(led, req).collect()}
    assert cov == {"C-04": ("SATISFIED", 2, "BLOCKED"), "C-05": ("MISSING", 0, "BLOCKED")}
    only = spark.createDataFrame([("C-04",)], "control_id string")
    assert QA.control_coverage(led, only).first().gate_result == "READY"
    assert rows(QA.control_evidence(led, req)) == [("C-04", "E1"), ("C-04", "E2")]
    o = QA.override_status(led).first()
    assert (o.overrides_found, o.status) == (2, "ESCALATED")
    os.mkdir(os.path.join(tmp_root, "more"))
    late = led.unionByName(_ledger(spark, os.path.join(tmp_root, "more"), [
        {"evidence_id": "O4", "control_id": "C-11", "status": "pass", "standard_controls_deferred": ["C-07"],
         "remediation_deadline": "2025-01-01"},
        {"evidence_id": "O5", "control_id": "C-11", "remediation_status": "completed", "standard_controls_deferred": ["C-08"]}]))
    assert rows(QA.deferred_controls(late)) == [("C-06", 1, True, "2025-02-01"), ("C-07", 2, True, "2025-01-01")]
    done = led.filter("evidence_id != 'O2'")
    assert QA.override_status(done).first().status == "REMEDIATED"
    pending = _ledger(spark, tmp_root, [{"evidence_id": "O3", "control_id": "C-11", "status": "pass"}])
    assert QA.override_status(pending).first().status == "PENDING"
    assert QA.override_status(led.filter("control_id != 'C-11'")).first().status == "CLEAN"
