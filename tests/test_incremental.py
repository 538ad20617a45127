"""Appends by the id index, mergeable service state, replay of snapshots, long
histories, sketches, epochs, VARIANT and ledgers with bad lines."""
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from costlake.operators import dims as D
from costlake.operators import facts as FA
from costlake.plans.queries import QUERIES, SALT, SERIES, raw_usage
from costlake.session import materialize
from costlake.sources import views as V
from costlake.sources.id_index import IndexedRaw
from costlake.sources.semi_structured import usage_from_json
from costlake.sources.usage import read_ledger_checked, usage_schema_findings
from tests.conftest import SF_SMALL, rows, usage_df
from tests.test_plans import plan


def lines(spark, *ids, day="2025-01-01"):
    return usage_df(spark, [(i, day, "L", "x", "1") for i in ids])


def test_append_by_index(spark, tmp_root):
    t = IndexedRaw(spark, tmp_root, buckets=4)
    assert t.append(lines(spark, "a", "a", "b", None), "l1").inserted == 3
    assert t.append(lines(spark, "a", "a", "b", None), "l1").inserted == 0        # delivered twice
    assert t.append(lines(spark, "b", "c", day=""), "l2").inserted == 1            # no start date
    assert t.append(lines(spark, "a", "c"), "l3").inserted == 0
    got = rows(t.read(), "identity_line_item_id", "line_item_usage_start_date", "load_id")
    assert got == [("a", "2025-01-01", "l1"), ("a", "2025-01-01", "l1"), ("b", "2025-01-01", "l1"), ("c", "", "l2")]
    assert rows(t.ids(), "identity_line_item_id") == [("a",), ("b",), ("c",)]
    t.close()
    again = IndexedRaw(spark, tmp_root, buckets=9)                                 # an old table keeps its buckets
    assert again.buckets == 4 and again.append(lines(spark, "a", "d"), "l4").inserted == 1
    again.close()


def test_a_load_that_failed_after_its_claim_is_run_again(spark, tmp_root, monkeypatch):
    t = IndexedRaw(spark, tmp_root, buckets=4)
    claimed = t.claimable(lines(spark, "a", "b"), "l1").filter("fresh")
    claimed.select("identity_line_item_id", F.lit("l1").alias("load_id")).repartition(4, "identity_line_item_id").write.insertInto(t.name)
    assert t.read() is None
    t.append(lines(spark, "a", "b"), "l1")
    assert t.read().count() == 2 and t.ids().count() == 2
    t.close()


def test_append_reads_the_index_without_an_exchange(spark, tmp_root):
    t = IndexedRaw(spark, tmp_root, buckets=4)
    t.append(lines(spark, "a", "b"), "l1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(t.claimable(lines(spark, "b", "c"), "l2"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    index_side = p[p.index("FileScan"):] if p.index("FileScan") > p.index("Exchange") else p
    assert "lines" not in re.findall(r"Location: [^\n]*", p).__str__()
    # both exchanges belong to the batch: its distinct ids, and their dealing into the buckets
    assert p.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in p, p
    assert "Exchange" not in index_side[index_side.index("FileScan"):]
    t.close()


def test_service_state_reads_no_history(spark):
    raw = raw_usage(spark, SF_SMALL)
    d = F.col("line_item_usage_start_date")
    state = materialize(D.merge_service_state(None, raw.filter(d < "2024-01-16")))
    merged = D.merge_service_state(state, raw.filter(d >= "2024-01-16"))
    assert rows(merged) == rows(D.service_observations(raw))
    empty = D.merge_service_state(state, raw.limit(0))
    assert rows(empty) == rows(state)


def test_replay_equals_six_loads(spark):
    series = V.snapshot_series(V.table(spark, SF_SMALL, "customer"), SERIES)
    dim = None
    for day in SERIES:
        dim = materialize(D.load_dim_customer(dim, series.filter(F.col("snapshot_date") == day).drop("snapshot_date"), SALT, day))
    got = D.replay_snapshots(series, SALT)
    assert got.columns == dim.columns
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(got) == key(dim)


def test_replay_rejects_a_customer_twice_on_a_day(spark):
    series = V.snapshot_series(V.table(spark, SF_SMALL, "customer"), SERIES[:2])
    with pytest.raises(Exception, match="duplicate key in customer snapshots"):
        D.replay_snapshots(series.unionByName(series.limit(1)), SALT).collect()


def test_active_pairs_against_every_pair(spark):
    rng = random.Random(5)
    days = [f"20{y:02}-{m:02}-{d:02}" for y in range(1, 9) for m in (1, 6, 12) for d in (1, 15, 28)]
    dates = sorted({rng.choice(days) + rng.choice(["", "", "T10:00:00Z"]) for _ in range(60)})
    versions = []
    for k in range(80):
        a, b = rng.choice(days), rng.choice([None, *days])
        versions.append((k, a, b if b is None or rng.random() < 0.9 else a))
    dim = spark.createDataFrame(versions, "customer_key long, effective_from string, effective_to string")
    got = rows(FA.active_pairs(dim, spark.createDataFrame([(d,) for d in dates], "usage_date string")))
    assert got == sorted((d, k) for k, a, b in versions for d in dates if (b is None or b >= a) and a <= d < (b or "9999-12-31"))


def test_no_version_filters_the_days(spark):
    dim = spark.createDataFrame([(1, "2024-01-01", None)], "customer_key long, effective_from string, effective_to string")
    p = plan(FA.active_pairs(dim, spark.createDataFrame([("2024-01-02",)], "usage_date string")))
    # the one lambda orders the array of days, once
    assert "slice(" in p and len(set(re.findall(r"lambdafunction\(\(*IF", p))) == 1 and "filter(" not in p.lower().replace("filter (", "")
    assert "NestedLoop" not in p


def test_sketches_of_days_give_ranges(spark):
    data = [(f"2024-01-{d:02}", (d * 37 + i * 7) % 5000) for d in range(1, 29) for i in range(400)]
    sk = FA.distinct_sketches(spark.createDataFrame(data, "usage_date string, c int"), "c")
    ranges = spark.createDataFrame([("2024-01-01", "2024-02-01"), ("2024-01-03", "2024-01-05"), ("2024-01-05", "2024-01-05")],
                                   "range_start string, range_end string")
    got = {(r.range_start, r.range_end): r.customers for r in FA.distinct_in_ranges(sk, ranges).collect()}
    for (lo, hi), n in got.items():
        exact = len({c for d, c in data if lo <= d < hi})
        assert abs(n - exact) <= 0.02 * exact
    assert set(got) == {("2024-01-01", "2024-02-01"), ("2024-01-03", "2024-01-05")}


def test_epochs_keep_the_service_dimension_and_facts(spark, tmp_root):
    """Two epochs with refresh equal a full load; a replayed epoch changes nothing."""
    from costlake.sources.tables import Warehouse
    from costlake.streaming.ingest import ingest_epochs, load_epoch
    raw = raw_usage(spark, SF_SMALL)
    cut = F.col("line_item_usage_start_date") < "2024-01-15"
    src, root = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "wh")
    raw.filter(cut).coalesce(1).write.mode("append").parquet(src)
    q = lambda: ingest_epochs(spark, src, root, os.path.join(tmp_root, "ck"), refresh=True, buckets=4)
    q()
    raw.filter(~cut).coalesce(1).write.mode("append").parquet(src)
    q()
    wh = Warehouse(spark, root)
    table = IndexedRaw(spark, f"{root}/raw_usage_indexed")
    first = table.read("epoch-0").drop("load_id", "usage_month")
    seen = [rows(wh.read(t).drop("_loaded_at", "_updated_at")) for t in ("dim_service", "fact_daily_cost", "service_state")]
    assert load_epoch(wh, table, first, "epoch-0", True, "again") == 0
    assert table.read().count() == raw.count()
    assert [rows(wh.read(t).drop("_loaded_at", "_updated_at")) for t in ("dim_service", "fact_daily_cost", "service_state")] == seen
    assert seen[2] == rows(D.service_observations(raw))
    ds = wh.read("dim_service")
    cols = wh.read("fact_daily_cost").drop("_loaded_at").columns
    assert seen[1] == rows(FA.load_fact_daily_cost(raw, ds, None, "x"), *cols)
    table.close()


def test_json_usage_lines(spark):
    ok = {"line": {"id": "1", "day": "2024-01-01"}, "product": {"code": "L", "types": ["L:1"]}, "cost": 1.25}
    cases = [ok, {**ok, "cost": None}, {k: v for k, v in ok.items() if k != "cost"}, {**ok, "cost": "1.25"}, {**ok, "line": {"id": 1, "day": {}}},
             {**ok, "product": {"code": None, "types": []}}]
    texts = [json.dumps(c) for c in cases] + ["{", "", "[]", None]
    valid, rejected = usage_from_json(spark.createDataFrame(list(enumerate(texts)), "n int, payload string"))
    assert [(r.n, r.id, None if r.cost is None else float(r.cost)) for r in valid.orderBy("n").collect()] == [(0, "1", 1.25), (1, "1", None), (2, "1", None)]
    assert [(r.n, r.problem) for r in rejected.orderBy("n").collect()] == [
        (3, "cost"), (4, "id,usage_date"), (5, "product_code,usage_type"), (6, "no JSON"), (7, "no JSON"),
        (8, "id,usage_date,product_code,usage_type"), (9, "no JSON")]


def test_ledger_with_bad_lines(spark, tmp_root):
    p = os.path.join(tmp_root, "ledger.jsonl")
    with open(p, "w") as f:
        f.write('{"evidence_id": "E1", "control_id": "C-04", "status": "pass"}\n\n  \n{"evidence_id": "E2"\n'
                '{"evidence_id": "E3", "status": "pass"}\n{"control_id": "C-04"}\n{"evidence_id": "E4", "control_id": "C-04", "standard_controls_deferred": 7}\n7\n')
    got = read_ledger_checked(spark, p)
    assert [r.evidence_id for r in got.valid.collect()] == ["E1"]
    assert sorted(r.reason for r in got.rejected.collect()) == ["no control_id", "no evidence_id", *["not a ledger entry"] * 3]
    assert got.counts == {"lines": 6, "rejected": 5}


def test_schema_findings_tell_spelling_from_absence(spark):
    df = usage_df(spark, []).withColumnRenamed("line_item_operation", "LINE_ITEM_OPERATION").drop("line_item_usage_type")
    assert [(f.name, f.problem, f.found) for f in usage_schema_findings(df.schema)] == [
        ("line_item_usage_type", "absent", None), ("line_item_operation", "spelling", "LINE_ITEM_OPERATION")]


def test_no_python_in_the_new_queries(spark):
    for name in ("scd2_replay", "active_pairs_long", "distinct_customers_range", "variant_usage"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        for bad in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def scan(df):
    """The file scan of a plan without an exchange, after it ran."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0)


def test_lookup_skips_row_groups(spark, tmp_root):
    from costlake.sources.tables import lookup, write_for_lookup
    df = spark.range(200_000).selectExpr("id * 2 AS customer_key", "cast(id as string) AS v", "'2024-01-01' AS usage_date")
    write_for_lookup(df.repartition(3), tmp_root + "/t", "customer_key", ["usage_date"], 200_000, row_group_bytes=200_000)
    t = spark.read.schema("customer_key bigint, v string, usage_date string").parquet(tmp_root + "/t")
    ids = spark.createDataFrame([(100_000,), (100_001,), (None,)], "customer_key bigint")
    got = lookup(t, "customer_key", ids)
    read = scan(got).metrics().apply("numOutputRows").value()
    assert [r.customer_key for r in got.collect()] == [100_000] and read < 40_000
    # an absent value inside the range of every row group: the Bloom filters alone tell
    mixed = spark.range(60_000).selectExpr("(id * 7919) % 60000 * 2 AS customer_key", "cast(id as string) AS v")
    (mixed.coalesce(1).write.option("parquet.bloom.filter.enabled#customer_key", "true").option("parquet.enable.dictionary", "false")
     .option("parquet.bloom.filter.expected.ndv#customer_key", "60000").parquet(tmp_root + "/u"))
    odd = lookup(spark.read.parquet(tmp_root + "/u"), "customer_key", spark.createDataFrame([(60_001,)], "customer_key bigint"))
    assert scan(odd).metrics().apply("numOutputRows").value() == 0


def test_many_keys_are_joined(spark, monkeypatch):
    from costlake.sources import tables
    monkeypatch.setattr(tables, "MAX_PUSHED_KEYS", 2)
    t = spark.range(100).withColumnRenamed("id", "k")
    assert rows(tables.lookup(t, "k", spark.createDataFrame([(1,), (5,), (7,), (7,)], "k bigint"))) == [(1,), (5,), (7,)]


def test_bucketed_target_is_not_exchanged(spark):
    from costlake.operators import quality as QA
    from costlake.sources.bucketed import bucketed, upsert_bucketed
    t = spark.createDataFrame([("d1", 1, 10), ("d1", 2, 20)], "d string, k long, v long")
    s = spark.createDataFrame([("d1", 2, 21), ("d2", 3, 30)], "d string, k long, v long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(t, ["d", "k"], 4) as target:
            out = upsert_bucketed(target, s, ["d", "k"], ["v"], 4, check_unique=False)
            p = plan(out)
            assert "Bucketed: true" in p and p.count("Exchange") == 1, p
            assert "Exchange hashpartitioning(d" not in plan(QA.grain_check(target, ["d", "k"], "t"))
            assert rows(out) == [("d1", 1, 10), ("d1", 2, 21), ("d2", 3, 30)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_overwrite_that_crashes_is_finished_by_the_next_reader(spark, tmp_root, monkeypatch):
    import shutil

    from costlake.sources.tables import Warehouse
    wh = Warehouse(spark, tmp_root)
    make = lambda *r: spark.createDataFrame(list(r), "usage_date string, v int")
    wh.replace("t", make(("d1", 1), ("d2", 2)), ["usage_date"])

    def crash(rows_, cols, loc):
        shutil.rmtree(f"{loc}/usage_date=d2")          # what a commit that dies half-way may leave
        raise OSError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_overwrite", staticmethod(crash))
        with pytest.raises(OSError):
            wh.write_partitions("t", make(("d2", 3), ("d2", 4), ("d3", 5)))
    assert rows(Warehouse(spark, tmp_root).read("t"), "usage_date", "v") == [("d1", 1), ("d2", 3), ("d2", 4), ("d3", 5)]
    wh.write_partitions("t", wh.read("t").filter("usage_date = 'd2'").withColumn("v", F.col("v") + 10))
    assert rows(wh.read("t"), "usage_date", "v") == [("d1", 1), ("d2", 13), ("d2", 14), ("d3", 5)]
    assert not os.listdir(f"{tmp_root}/t/_pending") or all(f.startswith(".") for f in os.listdir(f"{tmp_root}/t/_pending"))


def test_segment_cost_makes_no_pairs(spark):
    p = plan(QUERIES["segment_cost"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_vacuum_keeps_the_newest_versions(spark, tmp_root):
    from costlake.sources.tables import Warehouse
    wh = Warehouse(spark, tmp_root)
    for i in range(4):
        wh.replace("t", spark.range(i + 1))
    assert wh.vacuum("t") == 2 and wh.read("t").count() == 4
    assert wh.vacuum("t", keep=1) == 1 and wh.vacuum("t", keep=1) == 0 and wh.read("t").count() == 4
    wh.replace("t", spark.range(9))
    assert wh.read("t").count() == 9 and wh.vacuum("none") == 0


def test_sql_leaves_no_views(spark):
    from costlake.sources.tables import run_sql
    spark.range(3).createOrReplaceTempView("mine")
    out = run_sql(spark, "SELECT count(*) AS n FROM mine JOIN other USING (id) WHERE id >= :lo",
                  {"mine": spark.range(10), "other": spark.range(8)}, {"lo": 2})
    assert out.first().n == 6 and spark.table("mine").count() == 3
    assert "other" not in {t.name for t in spark.catalog.listTables()}
    spark.catalog.dropTempView("mine")
