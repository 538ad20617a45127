"""The customer fact grows by tasks, not by rows a task, and its rows are not shuffled."""

import os
import re

import pytest
from pyspark.sql import functions as F

from costlake.operators import dims as D
from costlake.operators import facts as FA
from costlake.operators import quality as QA
from costlake.operators.joins import dealt_joins
from costlake.plans.queries import QUERIES
from costlake.session import materialize
from costlake.sources import id_index
from costlake.sources.bucketed import bucketed, upsert_bucketed
from costlake.sources.tables import Warehouse, lookup, write_for_lookup

from .conftest import SF_SMALL, USAGE_COLS, rows, usage_df

KEYS = ["usage_date", "customer_key", "service_key"]
UPDATED = ["allocated_cost", "record_count", "null_cost_count", "_loaded_at"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_tasks(spark):
    """Tasks of 20 fact rows, and no broadcast but those asked for."""
    spark.conf.set("costlake.task.rows", "20")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("costlake.task.rows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def inputs(spark, customers=60):
    raw = usage_df(spark, [(str(i), f"2024-01-{1 + i % 9:02d}", "ec2", f"t{i % 3}", f"{i}.10") for i in range(54)])
    dim = spark.createDataFrame(
        [(k, k % 50, "s", "2024-01-01" if k < 50 else "2024-01-05", "2024-01-05" if k < 10 else None) for k in range(customers)],
        "customer_key long, customer_id long, segment string, effective_from string, effective_to string")
    return raw, D.load_dim_service(raw, None, "t"), dim


def test_fact_rows_get_tasks_by_their_number_and_stay_where_they_are(spark, small_tasks):
    fact = FA.customer_cost(*inputs(spark), "t")
    n = fact.count()
    assert fact.rdd.getNumPartitions() >= n // 20 > 8
    p = plan(QA.grain_check(fact, KEYS, "f"))
    assert not re.search(r"hashpartitioning\((usage_date#\d+L?, customer_key|_a#|_b#)", p), p
    assert QA.grain_check(fact, KEYS, "f").first().asDict() == {
        "table_name": "f", "row_count": n, "distinct_keys": n, "duplicate_keys": 0}


def test_pairs_of_listed_texts_are_those_of_days(spark, monkeypatch):
    dim = spark.createDataFrame(
        [(1, "2024-01-01", None), (2, "2024-01-02", "2024-01-03"), (3, "2024-01-02T12:00:00Z", "2024-01-03T06:00:00Z"),
         (4, "2024-01-05", "2024-01-04"), (5, None, None), (6, "2024-01-03", "2024-01-03")],
        "customer_key long, effective_from string, effective_to string")
    texts = ["2024-01-01", "2024-01-02", "2024-01-02T00:00:00Z", "2024-01-02T12:00:00Z", "2024-01-03",
             "2024-01-03T05:00:00Z", "2024-01-03T06:00:00Z", "2024-01-04", "", None, "2024-01-02"]
    dates = spark.createDataFrame([(t,) for t in texts], "usage_date string")
    got = rows(FA.active_pairs(dim, dates), "usage_date", "customer_key")
    versions = [(r.customer_key, r.effective_from, r.effective_to or "9999-12-31") for r in dim.collect() if r.effective_from]
    assert got == sorted((t, k) for t in set(texts) - {None} for k, a, b in versions if a <= t < b)
    monkeypatch.setattr(FA, "MAX_LISTED_DATES", 0)
    assert rows(FA.active_pairs(dim, dates), "usage_date", "customer_key") == got


def test_upsert_of_a_fact_in_buckets_by_customer_moves_no_row(spark, small_tasks):
    raw, ds, dim = inputs(spark)
    old = dim.filter("customer_key < 50").withColumn("effective_to", dim.effective_to.substr(1, 0))
    old = old.selectExpr("customer_key", "customer_id", "segment", "effective_from", "CAST(NULL AS string) AS effective_to")
    first = FA.load_fact_customer_cost(raw, ds, old, None, "run-1", buckets=16)
    want = rows(FA.load_fact_customer_cost(raw, ds, dim, first, "run-2", partitions_only=True))
    with bucketed(first, ["customer_key"], 16, dealt=True) as target, dealt_joins(spark):
        whole = upsert_bucketed(target, FA.load_fact_customer_cost(raw, ds, dim, None, "run-2", buckets=16),
                                KEYS, UPDATED, 16, check_unique=False, bucket_keys=["customer_key"])
        touched = FA.load_fact_customer_cost(raw, ds, dim, target, "run-2", partitions_only=True, buckets=16)
        for out in (whole, touched):
            p = plan(out)
            assert "ShuffledHashJoin" in p and "hashpartitioning(t_" not in p and "hashpartitioning(s_" not in p, p
            assert "Bucketed: true" in p and rows(out) == want
        with pytest.raises(ValueError):
            upsert_bucketed(target, first, KEYS, UPDATED, 16, bucket_keys=["other"])
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_lookup_files_are_written_from_ranged_pairs(spark, small_tasks, tmp_root):
    raw, ds, dim = inputs(spark)
    fact = FA.customer_cost(raw, ds, dim, "t", by_date=True)
    p = plan(fact)
    assert p.count("rangepartitioning(usage_date") == 1
    write_for_lookup(fact, f"{tmp_root}/t", "customer_key", ["usage_date"], 60, dealt=True)
    got = spark.read.schema("customer_key long, service_key long, usage_date string").parquet(f"{tmp_root}/t")
    plain = FA.customer_cost(raw, ds, dim, "t").filter("customer_key % 10 = 3")
    assert rows(lookup(got, "customer_key", dim.filter("customer_key % 10 = 3").select("customer_key")), *KEYS) == rows(plain, *KEYS)


def test_staged_partitions_keep_their_kinds_and_are_not_dealt_again(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    make = lambda *r: spark.createDataFrame(list(r), "v int, usage_date string")
    wh.replace("t", make((1, "2024-01-01"), (2, "007"), (3, None)), ["usage_date"])
    wh.write_partitions("t", make((4, "007"), (5, None), (6, "2024-01-02")))
    assert sorted((r.v, r.usage_date) for r in wh.read("t").collect()) == [
        (1, "2024-01-01"), (4, "007"), (5, None), (6, "2024-01-02")]
    wh.write_partitions("t", make())
    assert wh.read("t").count() == 4 and not [f for f in os.listdir(f"{tmp_root}/t/_staged") if not f.startswith(".")]


def test_replay_deals_snapshots_over_tasks_by_their_rows(spark, small_tasks):
    snaps = spark.createDataFrame(
        [(d, k, f"c{k}@example.com", f"555-{k:07d}", "a", "b", "s" if (k + i) % 3 else "t")
         for k in range(100) for i, d in enumerate(["2024-01-01", "2024-01-05", "2024-01-09"])],
        "snapshot_date string, customer_id long, email string, phone string, first_name string, last_name string, segment string")
    out = D.replay_snapshots(snaps, "costlake-demo-salt")
    got = rows(out, "customer_key")
    assert got == [(i,) for i in range(1, len(got) + 1)]
    first = [r.customer_id for r in out.filter("effective_from = '2024-01-01'").orderBy("customer_key").collect()]
    assert first == list(range(100))


def test_json_lines_are_parsed_once_for_both_frames(spark):
    from costlake.sources.semi_structured import usage_from_json
    texts = spark.createDataFrame([(1, '{"line": {"id": "1", "day": "2024-01-01"}, "product": {"code": "a", "types": ["a:1"]}, "cost": 1.5}'),
                                   (2, "{")], "event_id long, payload string")
    valid, rejected = usage_from_json(texts)
    assert "parse_json" not in plan(valid) + plan(rejected)
    assert [r.event_id for r in valid.collect()] == [1] and [(r.event_id, r.problem) for r in rejected.collect()] == [(2, "no JSON")]


def test_lines_are_appended_without_a_stored_copy_and_may_be_read_from_their_own_load(spark, small_tasks, tmp_root, monkeypatch):
    """An append stores ids beside the lines, never the lines twice; it may read what it replaces."""
    stored = []
    monkeypatch.setattr(id_index, "materialize", lambda df, m=None: stored.append(df.columns) or materialize(df, m))
    batch = usage_df(spark, [(str(i % 50), f"2024-0{1 + i % 3}-{1 + i % 9:02d}", "ec2", "t", "1") for i in range(90)])
    for limit in ("10", "1000"):                                          # ids joined by a shuffle, and broadcast
        spark.conf.set("costlake.broadcast.maxRows", limit)
        parts = spark.conf.get("spark.sql.shuffle.partitions")
        t = id_index.IndexedRaw(spark, f"{tmp_root}/{limit}", buckets=4)
        try:
            assert t.append(batch.filter("identity_line_item_id < '3'"), "l1").inserted == 46
            held = rows(t.read())
            assert t.append(t.read("l1"), "l1").inserted == 0 and rows(t.read()) == held
            r = t.append(batch, "l2")
            assert r.inserted == 44 and r.metrics["new_ids"] == 27 and t.read().count() == 90
            assert t.append(batch.filter("identity_line_item_id < '3'"), "l3").metrics == {"inserted": 0, "null_cost": 0, "new_ids": 0}
        finally:
            t.close()
            spark.conf.unset("costlake.broadcast.maxRows")
        assert spark.conf.get("spark.sql.shuffle.partitions") == parts
    assert stored and all(set(c) == {"identity_line_item_id", "fresh"} for c in stored)


def test_rows_meet_the_ids_before_they_become_lines(spark, small_tasks, tmp_root):
    """``lines_of`` gets only the kept rows, as narrow as they came; what it drops claims no id."""
    seen = []

    def lines_of(r):
        seen.append(r)
        made = r.filter("n % 5 != 0")
        return made.select(*[F.col("identity_line_item_id") if c == "identity_line_item_id" else F.concat(F.lit("2024-01-0"), F.col("n") % 9 + 1)
                             if c == "line_item_usage_start_date" else F.lit("1") for c in USAGE_COLS]).toDF(*USAGE_COLS)

    t = id_index.IndexedRaw(spark, tmp_root, buckets=4)
    at = lambda lo, hi: spark.createDataFrame([(str(i % 20), i) for i in range(lo, hi)], "identity_line_item_id string, n int")
    assert t.append(at(0, 10), "l1", lines_of).inserted == 8             # 0 and 5 are no lines, and stay free
    assert t.append(at(0, 32), "l2", lines_of).inserted == 9
    ids = [r[0] for r in rows(t.ids())]
    assert sorted(map(int, ids)) == [i for i in range(20) if i % 5]
    assert [r.columns for r in seen[1::2]] == [["identity_line_item_id", "n"]] * 2 and seen[3].count() == 9
    t.close()


def test_a_snapshot_is_masked_once_in_many_tasks(spark, monkeypatch):
    parts = []
    monkeypatch.setattr(D, "materialize", lambda df: parts.append(df.rdd.getNumPartitions()) or materialize(df), raising=False)
    cols = "customer_id long, email string, phone string, first_name string, last_name string, segment string"
    snap = lambda s: spark.createDataFrame([(k, f"c{k}@example.com", f"555-{k:07d}", "a", "b", s if k % 3 else "x")
                                            for k in range(30)], cols).coalesce(1)
    d1 = D.load_dim_customer(None, snap("s"), "salt", "2024-01-01")
    d2 = D.load_dim_customer(d1, snap("t"), "salt", "2024-01-15")
    assert parts == [8, 8] and "invalid customer row" not in plan(d2)
    assert d2.count() == 50 and d2.filter("is_current").count() == 30


def test_control_checks_read_one_warehouse(spark, monkeypatch):
    made = []
    for where, name in ((D, "mask_snapshot"), (FA, "service_daily")):
        monkeypatch.setattr(where, name, lambda *a, _f=getattr(where, name), _n=name: made.append(_n) or _f(*a))
    assert {r.control_id: r.evidence_count for r in QUERIES["control_coverage"](spark, SF_SMALL).collect()} == {
        "C-04": 4, "C-05": 0, "C-06": 7, "C-08": 7}
    assert sorted(made) == ["mask_snapshot", "mask_snapshot", "service_daily"]
