"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads whole tables, runs the library operators and casts its
output columns explicitly (money to double, counts to bigint, dates as
ISO text) so the SQL oracle in ``costlake.plans.oracle`` can match it
column for column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.functions.masking import is_masked
from costlake.operators import dims as D
from costlake.operators import facts as FA
from costlake.operators import quality as QA
from costlake.operators import summary as S
from costlake.operators.joins import dealt_joins, tasks_for
from costlake.schemas import MONEY_2DP, SERVICE_CATEGORIES
from costlake.session import materialize, scratch_path
from costlake.sources import views as V
from costlake.sources.id_index import IDS_PER_BUCKET, LOAD, MONTH, IndexedRaw
from costlake.sources.semi_structured import usage_from_json
from costlake.sources.bucketed import bucketed, upsert_bucketed
from costlake.sources.tables import Warehouse, lookup, run_sql, write_for_lookup
from costlake.sources.usage import new_usage_rows, normalize_usage, read_ledger_checked, usage_metrics_frame

# Fixed parameters of the named queries.
RUN_TS = "2024-02-01 00:00:00"
SALT = "costlake-demo-salt"
FIRST_LOAD_BEFORE = "2024-01-16"          # dim_service_reload: first load sees earlier dates
LATE_CUTOFF_TS = "2024-01-20 12:00:00"    # fact_daily_upsert: run 1 sees events before this
RERUN_FROM_TS = "2024-01-10 00:00:00"     # fact_daily_upsert: run 2 re-reads events from here
TABLE_BEFORE = "1998-07-01"               # new_usage_rows: loaded table holds earlier ship dates
BATCH_FROM = "1998-01-01"                 # new_usage_rows: the batch starts here (overlap)
SLICE_FROM = "2024-01-15"                 # daily_cost_since: slice start
# Controls the derived evidence covers, and the controls a gate requires.
CONTROL_OF_CHECK = {"dq_pii": "C-04", "dq_ranges": "C-06", "dq_scd2": "C-08"}
REQUIRED_CONTROLS = ["C-04", "C-05", "C-06", "C-08"]

Query = Callable[[SparkSession, str], DataFrame]


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select([F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


# --- shared inputs -------------------------------------------------------------

def raw_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw usage layer (14 text columns) from ``events``."""
    return normalize_usage(V.usage_from_events(V.table(spark, sf_dir, "events")))


def raw_usage_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw usage layer from ``lineitem`` joined to ``part`` (1995-2001)."""
    return normalize_usage(V.usage_from_lineitem(V.table(spark, sf_dir, "lineitem"),
                                                 V.table(spark, sf_dir, "part")))


# --- summary family ------------------------------------------------------------

def q_daily_cost_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dbl(S.daily_cost_summary(raw_usage(spark, sf_dir)), "daily_cost")


def q_cost_trend_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = S.compute_trend(S.daily_cost_summary(raw_usage(spark, sf_dir)), 7)
    return _dbl(t, "daily_cost")


def q_top_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dbl(S.top_services_by_cost(S.daily_cost_summary(raw_usage(spark, sf_dir)), 10),
                "total_cost")


def q_month_over_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = S.month_over_month_change(S.daily_cost_summary(raw_usage_long(spark, sf_dir)))
    return _dbl(m, "monthly_cost")


def q_weekly_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = S.detect_cost_anomalies(S.daily_cost_summary(raw_usage_long(spark, sf_dir)), 0.20)
    return _dbl(a, "weekly_cost", "prev_weekly_cost")


# --- dimensions --------------------------------------------------------------------

def dim_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.load_dim_service(raw_usage(spark, sf_dir), None, RUN_TS)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD2 dimension after loading snapshot v1 then v2 (each load is a table
    version in the pipeline; here the first is materialised)."""
    cust = V.table(spark, sf_dir, "customer")
    d1 = D.load_dim_customer(None, V.snapshot_v1(cust), SALT, V.SNAPSHOT_V1_DATE)
    return D.load_dim_customer(d1, V.snapshot_v2(cust), SALT, V.SNAPSHOT_V2_DATE)


_DIM_SERVICE_OUT = ["service_key", "product_code", "usage_type", "service_category",
                    "first_seen_date", "last_seen_date"]


def q_dim_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_service(spark, sf_dir).select(*_DIM_SERVICE_OUT)


def q_dim_service_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_usage(spark, sf_dir)
    first = materialize(D.load_dim_service(
        raw.filter(F.col("line_item_usage_start_date") < FIRST_LOAD_BEFORE), None, "load-1"))
    return D.load_dim_service(raw, first, "load-2").select(*_DIM_SERVICE_OUT, "_loaded_at", "_updated_at")


def q_masked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = D.mask_snapshot(V.snapshot_v2(V.table(spark, sf_dir, "customer")), SALT)
    return m.select("*", is_masked("email_token", "email").alias("email_masked"),
                    is_masked("phone_redacted", "phone").alias("phone_masked"))


def q_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = V.table(spark, sf_dir, "customer")
    return D.snapshot_diff(V.snapshot_v1(cust), V.snapshot_v2(cust))


def q_dim_customer_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_customer(spark, sf_dir)


# --- facts -------------------------------------------------------------------------

def fact_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_usage(spark, sf_dir)
    dim = materialize(D.load_dim_service(raw, None, RUN_TS))
    return FA.load_fact_daily_cost(raw, dim, None, RUN_TS)


def q_fact_daily_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dbl(fact_daily(spark, sf_dir), "daily_cost").drop("_loaded_at")


def q_fact_daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data: run 1 sees events up to noon of 2024-01-20, run 2 re-reads
    from 2024-01-10 on; the upsert keeps run-1 days, replaces the rest."""
    ev = V.table(spark, sf_dir, "events")
    raw = raw_usage(spark, sf_dir)
    dim = materialize(D.load_dim_service(raw, None, RUN_TS))
    raw1 = normalize_usage(V.usage_from_events(ev.filter(F.col("ts") < F.lit(LATE_CUTOFF_TS).cast("timestamp_ntz"))))
    raw2 = normalize_usage(V.usage_from_events(ev.filter(F.col("ts") >= F.lit(RERUN_FROM_TS).cast("timestamp_ntz"))))
    f1 = materialize(FA.load_fact_daily_cost(raw1, dim, None, "run-1"))
    return _dbl(FA.load_fact_daily_cost(raw2, dim, f1, "run-2"), "daily_cost")


def _customer_fact(spark: SparkSession, sf_dir: str, keep_dim: bool = True):
    """Raw lines and both dimensions; the customer dimension is written once
    (``keep_dim``) when the query reads it several times."""
    raw = raw_usage(spark, sf_dir)
    ds = D.load_dim_service(raw, None, RUN_TS)
    dc = dim_customer(spark, sf_dir)
    return raw, ds, materialize(dc) if keep_dim else dc


def q_active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every line's service is in the dimension that these lines give, so its dates are theirs.
    raw, _, dc = _customer_fact(spark, sf_dir, keep_dim=False)
    return FA.active_customers_per_date(dc, raw.select(F.col("line_item_usage_start_date").alias("usage_date")))


def q_fact_customer_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc = _customer_fact(spark, sf_dir)
    return _dbl(FA.customer_cost(raw, ds, dc, RUN_TS), "allocated_cost").drop("_loaded_at")


def q_customer_cost_timed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer fact where a fixed share of the usage dates, the first
    and the last among them, carries a time part."""
    raw, ds, dc = _customer_fact(spark, sf_dir)
    d = F.col("line_item_usage_start_date")
    day = F.substring(d, 9, 2).cast("int")
    timed = raw.withColumn("line_item_usage_start_date", F.when(
        (day % 3 == 1) | (day % 10 == 0), F.concat(d, F.lit("T00:00:00Z"))).otherwise(d))
    return _dbl(FA.customer_cost(timed, ds, dc, RUN_TS), "allocated_cost").drop("_loaded_at")


def q_fact_customer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 stored form (T17): run 1 allocates to the customers of snapshot v1, run
    2 to those of v2; rows of versions closed in between stay as run 1 left them."""
    raw = raw_usage(spark, sf_dir)
    ds = materialize(D.load_dim_service(raw, None, RUN_TS))
    cust = V.table(spark, sf_dir, "customer")
    d1 = materialize(D.load_dim_customer(None, V.snapshot_v1(cust), SALT, V.SNAPSHOT_V1_DATE))
    d2 = materialize(D.load_dim_customer(d1, V.snapshot_v2(cust), SALT, V.SNAPSHOT_V2_DATE))
    n = _fact_buckets(raw, ds, d2)
    with bucketed(FA.load_fact_customer_cost(raw, ds, d1, None, "run-1", buckets=n), ["customer_key"], n, dealt=True) as f1, dealt_joins(spark):
        out = FA.load_fact_customer_cost(raw, ds, d2, f1, "run-2", partitions_only=True, buckets=n)
        return _dbl(materialize(out), "allocated_cost")


def _fact_buckets(raw: DataFrame, ds: DataFrame, dc: DataFrame) -> int:
    """Buckets by customer that hold a task's rows of the customer fact each."""
    rows = FA.customer_shares(FA.materialized_service_daily(raw, ds)[0], dc)[1]
    return max(FACT_BUCKETS, tasks_for(raw.sparkSession, rows))


def q_segment_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc = _customer_fact(spark, sf_dir)
    return _dbl(FA.segment_cost_by_counts(raw, ds, dc), "total_cost")


def q_segment_cost_of_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 from the customer fact itself."""
    raw, ds, dc = _customer_fact(spark, sf_dir)
    return _dbl(FA.segment_cost(FA.customer_cost(raw, ds, dc, RUN_TS), dc), "total_cost")


def q_distinct_customers_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc = _customer_fact(spark, sf_dir)
    return FA.distinct_customers_per_date(FA.customer_cost(raw, ds, dc, RUN_TS))


def q_enriched_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_usage(spark, sf_dir)
    ds = materialize(D.load_dim_service(raw, None, RUN_TS))
    f = FA.load_fact_daily_cost(raw, ds, None, RUN_TS)
    e = FA.enrich_daily_fact(f, ds)
    top = e.orderBy(F.col("daily_cost").desc(), F.col("usage_date"), F.col("service_key")).limit(5)
    return _dbl(top.select("usage_date", "service_key", "product_code", "usage_type",
                           "service_category", "daily_cost"), "daily_cost")


# --- ingest / SQL surface -----------------------------------------------------------------

def q_new_usage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 on the long view: the loaded table holds ship dates before 1998-07,
    the batch everything from 1998-01; ids repeat inside the batch."""
    raw = raw_usage_long(spark, sf_dir)
    d = F.col("line_item_usage_start_date")
    new = new_usage_rows(raw.filter(d >= BATCH_FROM), raw.filter(d < TABLE_BEFORE))
    return new.select("identity_line_item_id", "line_item_usage_start_date", "line_item_product_code",
                      "line_item_usage_type", "line_item_unblended_cost")


def q_segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + P7 through the SQL surface."""
    return run_sql(spark, "SELECT segment, COUNT(*) AS customers FROM dim_customer "
                          "WHERE is_current GROUP BY segment",
                   {"dim_customer": dim_customer(spark, sf_dir)})


def q_daily_cost_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 slice with a bound parameter through the SQL surface."""
    f = fact_daily(spark, sf_dir)
    return run_sql(spark, "SELECT usage_date, service_key, CAST(daily_cost AS DOUBLE) AS daily_cost, "
                          "record_count FROM fact_daily_cost WHERE usage_date >= :start",
                   {"fact_daily_cost": f}, {"start": SLICE_FROM})


# --- data quality -------------------------------------------------------------------------

def _warehouse(spark: SparkSession, sf_dir: str):
    raw, ds, dc = _customer_fact(spark, sf_dir)
    ds = materialize(ds)
    sd = FA.materialized_service_daily(raw, ds)     # shared by both facts
    fd = FA.load_fact_daily_cost(raw, ds, None, RUN_TS, service_day=sd[0])
    fc = FA.customer_cost(raw, ds, dc, RUN_TS, service_day=sd)
    return raw, ds, dc, fd, fc


def q_dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc, fd, fc = _warehouse(spark, sf_dir)
    return QA.referential_integrity(fc, fd, dc, ds)


def q_dq_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc, fd, fc = _warehouse(spark, sf_dir)
    parts = [
        QA.grain_check(ds, ["service_key"], "dim_service"),
        QA.grain_check(ds, ["product_code", "usage_type"], "dim_service.natural_key"),
        QA.grain_check(dc, ["customer_key"], "dim_customer"),
        QA.grain_check(fd, ["usage_date", "service_key"], "fact_daily_cost"),
        QA.grain_check(fc, ["usage_date", "customer_key", "service_key"], "fact_customer_cost"),
        QA.grain_check(raw, ["identity_line_item_id"], "raw_usage"),
        QA.grain_check(raw_usage_long(spark, sf_dir), ["identity_line_item_id"], "raw_usage_long"),
    ]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def q_dq_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_usage(spark, sf_dir)
    return QA.reconcile_counts(fact_daily(spark, sf_dir), raw)


def q_dq_reconcile_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc, fd, fc = _warehouse(spark, sf_dir)
    return _dbl(QA.reconcile_cost(fc, fd), "allocated_total", "daily_cost", "diff")


def q_dq_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QA.scd2_integrity(dim_customer(spark, sf_dir))


def q_dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QA.cost_range_checks(fact_daily(spark, sf_dir), "daily_cost")


def q_dq_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, ds, dc, fd, fc = _warehouse(spark, sf_dir)
    return QA.pii_leak_check(dc, fd, fc)


def q_control_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 over an evidence ledger derived from the quality checks: each check
    row is one evidence entry of its control, ``pass`` when it has no
    violation. The checks read one warehouse, made once."""
    _, _, dc, fd, fc = _warehouse(spark, sf_dir)
    checks = {"dq_pii": QA.pii_leak_check(dc, fd, fc), "dq_ranges": QA.cost_range_checks(fd, "daily_cost"),
              "dq_scd2": QA.scd2_integrity(dc)}
    ledger = None
    for q, control in CONTROL_OF_CHECK.items():
        rows = checks[q].select(
            F.concat(F.lit(q + ":"), F.col("check_name")).alias("evidence_id"),
            F.lit(control).alias("control_id"),
            F.when(F.col("violations") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
        ledger = rows if ledger is None else ledger.unionByName(rows)
    required = spark.createDataFrame([(c,) for c in REQUIRED_CONTROLS], "control_id string")
    return QA.control_coverage(ledger, required)


def q_override_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 over a ledger derived from the grain checks: each table's check is
    evidence for C-06; a failing one (the long usage view repeats ids, T1) is
    deferred by an emergency override (C-11) whose remediation is pending."""
    grain = q_dq_grain(spark, sf_dir)
    failing = F.col("duplicate_keys") > 0
    evidence = grain.select(F.concat(F.lit("dq_grain:"), F.col("table_name")).alias("evidence_id"),
                            F.lit("C-06").alias("control_id"),
                            F.when(failing, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
                            F.lit(None).cast("string").alias("remediation_status"))
    overrides = grain.filter(failing).select(
        F.concat(F.lit("override:"), F.col("table_name")).alias("evidence_id"),
        F.lit("C-11").alias("control_id"), F.lit("pass").alias("status"),
        F.lit("pending").alias("remediation_status"))
    return QA.override_status(evidence.unionByName(overrides))


def q_usage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run counters of the raw usage layer (T19: zero and NULL together)."""
    return usage_metrics_frame(raw_usage(spark, sf_dir))


def q_duplicate_usage_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that repeat in the long usage view, with their counts."""
    return QA.duplicate_keys(raw_usage_long(spark, sf_dir), ["identity_line_item_id"])


# --- inputs with faults: the checks and edge rules must see them -----------------------------

ID, COST, PRODUCT = "identity_line_item_id", "line_item_unblended_cost", "line_item_product_code"


def q_dq_orphans_old_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both facts against dimensions that lack the second customer
    load and every third usage type."""
    raw, ds, dc, fd, fc = _warehouse(spark, sf_dir)
    old_customers = dc.filter(F.col("effective_from") < V.SNAPSHOT_V2_DATE)
    return QA.referential_integrity(fc, fd, old_customers, ds.filter(~F.endswith("usage_type", F.lit(":2"))))


def q_dq_ranges_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: the daily fact with NULL, negative and three-decimal costs, bad
    counts, lost keys and empty dates, by service key and day."""
    key, day = F.col("service_key"), F.substring("usage_date", 9, 2).cast("int")
    cost = F.col("daily_cost").cast("decimal(30,3)")
    bad = (F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, -1 - F.abs(cost))
           .when(key % 5 == 2, cost + F.lit("0.001").cast("decimal(4,3)")).otherwise(cost))
    f = fact_daily(spark, sf_dir).select(
        F.when(day % 10 != 4, F.col("usage_date")).otherwise("").alias("usage_date"),
        F.when(day % 10 != 3, key).alias("service_key"), bad.cast("decimal(32,3)").alias("daily_cost"),
        F.when(key % 4 != 0, F.col("record_count")).otherwise(0).alias("record_count"),
        F.when(key % 4 != 1, F.col("null_cost_count")).otherwise(-1).alias("null_cost_count"))
    return QA.cost_range_checks(f, "daily_cost")


def q_dq_scd2_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: the customer dimension with doubly current, never current, open
    closed, backward and doubly keyed versions, by customer id."""
    k = F.col("customer_id") % 13
    d = dim_customer(spark, sf_dir).select(
        "customer_id", "effective_from",
        F.when((k == 5) & (F.col("customer_key") % 2 == 1), F.col("customer_key") - 1)
        .otherwise(F.col("customer_key")).alias("customer_key"),
        F.when(k == 4, F.lit("2023-12-31")).when(k != 3, F.col("effective_to")).alias("effective_to"),
        F.when(k == 1, F.lit(True)).when(k == 2, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"))
    return QA.scd2_integrity(d)


def q_dq_pii_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: a dimension with raw and upper-cased e-mail tokens and raw phones,
    and a fact with two columns named like personal data."""
    k = F.col("customer_id") % 7
    d = dim_customer(spark, sf_dir).select(
        F.when(k == 1, F.concat("first_name", F.lit("@example.com"))).when(k == 2, F.upper("email_token"))
        .otherwise(F.col("email_token")).alias("email_token"),
        F.when(k == 3, F.concat(F.lit("555-000"), F.col("customer_id").cast("string")))
        .otherwise(F.col("phone_redacted")).alias("phone_redacted"))
    fact = fact_daily(spark, sf_dir).withColumn("Email", F.lit("")).withColumn("phone", F.lit(""))
    return QA.pii_leak_check(d, fact)


def _usage_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage lines where six of nine events are named by a mapped product code."""
    at = F.col(ID).cast("bigint") % 9
    codes = F.array(*[F.lit(c) for c in sorted(SERVICE_CATEGORIES)])
    return raw_usage(spark, sf_dir).withColumn(
        PRODUCT, F.when(at < F.size(codes), F.get(codes, at.cast("int"))).otherwise(F.col(PRODUCT)))


def q_dim_service_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load sees early lines of unmapped services, the
    second every line; the mapped services are new in it."""
    raw = _usage_by_code(spark, sf_dir)
    early = raw.filter((F.col("line_item_usage_start_date") < FIRST_LOAD_BEFORE)
                       & ~F.col(PRODUCT).isin(*SERVICE_CATEGORIES))
    first = materialize(D.load_dim_service(early, None, "load-1"))
    return D.load_dim_service(raw, first, "load-2").select(*_DIM_SERVICE_OUT, "_loaded_at", "_updated_at")


def q_top_services_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, A5: usage types as services; those named ``S...`` are credits, the
    others cost nothing, so the limit cuts a tie that names must break."""
    raw = raw_usage_long(spark, sf_dir).withColumn(PRODUCT, F.col("line_item_usage_type"))
    one = raw.withColumn(COST, F.when(F.startswith(PRODUCT, F.lit("S")), F.concat(F.lit("-"), F.col(COST))).otherwise("0"))
    return _dbl(S.top_services_by_cost(S.daily_cost_summary(one), 10), "total_cost")


def q_weekly_anomalies_from_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of every month costs nothing, so weeks rise from zero."""
    raw = raw_usage_long(spark, sf_dir)
    day = F.substring("line_item_usage_start_date", 9, 2).cast("int")
    half = raw.withColumn(COST, F.when(day <= 15, F.lit("0.00")).otherwise(F.col(COST)))
    return _dbl(S.detect_cost_anomalies(S.daily_cost_summary(half), 0.20), "weekly_cost", "prev_weekly_cost")


def q_masked_customers_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded upper-case e-mails and phones with other characters."""
    c = V.snapshot_v2(V.table(spark, sf_dir, "customer"))
    c = c.withColumn("email", F.concat(F.lit("  "), F.upper("email"), F.lit(" "))).withColumn(
        "phone", F.concat(F.lit("+1 ("), F.translate("phone", "-", ") "), F.lit(" ext.")))
    return D.mask_snapshot(c, SALT)


def q_usage_metrics_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without an id, and costs that are truly zero."""
    n = F.col(ID).cast("bigint")
    return usage_metrics_frame(raw_usage(spark, sf_dir)
                               .withColumn(COST, F.when(n % 50 == 8, F.lit("0.00")).otherwise(F.col(COST)))
                               .withColumn(ID, F.when(n % 40 != 3, F.col(ID))))


def q_control_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 detail: the passing evidence ids of required controls, over the
    faulty ranges (C-06) and versions (C-08) and the clean ranges (C-07, not required)."""
    checks = {"dq_ranges_faulty": "C-06", "dq_scd2_faulty": "C-08", "dq_ranges": "C-07"}
    parts = [QUERIES[q](spark, sf_dir).select(
        F.concat(F.lit(q + ":"), F.col("check_name")).alias("evidence_id"), F.lit(control).alias("control_id"),
        F.when(F.col("violations") < 20, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
        for q, control in checks.items()]
    required = spark.createDataFrame([(c,) for c in REQUIRED_CONTROLS], "control_id string")
    return QA.control_evidence(parts[0].unionByName(parts[1]).unionByName(parts[2]), required)


# --- appends, loads and replays that do not read the history -------------------------------------

FACT_CUSTOMER_KEYS = ["usage_date", "customer_key", "service_key"]
FACT_BUCKETS = 16
APPEND_CUTS = ["1996-06-01", "1998-01-01", "1999-09-01"]           # append_indexed: first days of batches 2-4
SERVICE_CUTS = ["2024-01-08", "2024-01-15", "2024-01-22"]          # dim_service_incremental: likewise
SERIES = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01", "2024-02-15"]
LONG_SERIES = ["1995-03-01", "1996-01-15", "1997-07-01", "1998-02-10", "1999-12-31", "2001-06-01"]
RANGES = [("2024-01-01", "2024-01-08"), ("2024-01-05", "2024-01-20"), ("2024-01-10", "2024-01-11"),
          ("2024-01-01", "2024-03-01"), ("2023-01-01", "2023-02-01")]


def _batches(raw: DataFrame, cuts: list[str], day: Column | None = None) -> list[DataFrame]:
    """``raw`` cut at the given usage dates (``day``: where rows have theirs)."""
    d = F.col("line_item_usage_start_date") if day is None else day
    edges = ["", *cuts, None]
    return [raw.filter((d >= lo) & (d < hi)) if hi else raw.filter(d >= lo) for lo, hi in zip(edges, edges[1:])]


def q_append_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 by the id index: four batches by ship date; the second is delivered again
    under its own name and under another one, and neither changes a line."""
    items, part = V.table(spark, sf_dir, "lineitem"), V.table(spark, sf_dir, "part")
    table = IndexedRaw(spark, scratch_path(spark, "raw"), buckets=max(16, -(-items.count() // IDS_PER_BUCKET)))
    # Cut as rows of the table: the view's lines are made of those that an append keeps.
    batches = _batches(V.with_line_id(items), APPEND_CUTS, F.to_date("l_shipdate").cast("string"))
    lines_of = lambda rows: V.usage_from_lineitem(rows, part)
    for i, b in enumerate(batches, 1):
        table.append(b, f"batch-{i}", lines_of)
    table.append(batches[1], "batch-2", lines_of)
    table.append(batches[1], "batch-2-again", lines_of)
    table.close()
    return table.read().select(ID, "line_item_usage_start_date", PRODUCT, COST, LOAD)


def q_dim_service_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 from mergeable state: the dimension after each of four batches."""
    state = dim = out = None
    for i, b in enumerate(_batches(_usage_by_code(spark, sf_dir), SERVICE_CUTS), 1):
        state = materialize(D.merge_service_state(state, b))
        dim = materialize(D.dim_service_from(state, dim, f"load-{i}"))
        after = dim.select(F.lit(i).cast("bigint").alias("load"), *_DIM_SERVICE_OUT, "_loaded_at", "_updated_at")
        out = after if out is None else out.unionByName(after)
    return out


def q_scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six snapshots at once."""
    return D.replay_snapshots(V.snapshot_series(V.table(spark, sf_dir, "customer"), SERIES), SALT)


def q_active_pairs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over the years of the long usage view: per version, which of its days
    have usage (their number, first, last and the sum of their day numbers)."""
    series = V.snapshot_series(V.table(spark, sf_dir, "customer"), LONG_SERIES)
    dim = materialize(D.replay_snapshots(series, SALT))
    dates = V.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").cast("string").alias("usage_date")).distinct()
    pairs = FA.active_pairs(dim, materialize(dates))
    # As days and not as texts: a minimum of texts would have every pair sorted.
    days = pairs.select("customer_key", F.to_date("usage_date").alias("day"))
    return days.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n_dates"), F.min("day").cast("string").alias("first_date"), F.max("day").cast("string").alias("last_date"),
        F.sum(F.datediff("day", F.lit("1990-01-01").cast("date")).cast("bigint")).alias("day_sum"))


def q_distinct_customers_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 by stored sketches, one per date: every range within 2 % of the exact
    number of accounts (which a full pass counts beside it)."""
    raw = raw_usage(spark, sf_dir).select(F.col("line_item_usage_start_date").alias("usage_date"),
                                          F.col("line_item_usage_account_id").alias("account"))
    sketches = materialize(FA.distinct_sketches(raw, "account"))
    ranges = spark.createDataFrame(RANGES, "range_start string, range_end string")
    about = FA.distinct_in_ranges(sketches, ranges)
    in_range = [F.when((F.col("usage_date") >= lo) & (F.col("usage_date") < hi), F.struct(F.lit(lo).alias("range_start"), F.lit(hi).alias("range_end")))
                for lo, hi in RANGES]
    exact = (raw.distinct().select("account", F.explode(F.filter(F.array(*in_range), lambda r: r.isNotNull())).alias("r"))
             .groupBy("r.range_start", "r.range_end").agg(F.countDistinct("account").alias("exact")))
    return exact.join(about, ["range_start", "range_end"], "left").select(
        "range_start", "range_end", "exact",
        (F.abs(F.col("customers") - F.col("exact")) <= F.col("exact") * 0.02).alias("within_2pct"))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream over usage lines in files, several epochs, then the first
    epoch delivered again; the raw table equals the batch."""
    from costlake.streaming.ingest import ingest_epochs, load_epoch

    root = scratch_path(spark, "stream")
    lines = raw_usage(spark, sf_dir)
    cut = F.col("line_item_usage_start_date") < SERVICE_CUTS[1]
    (lines.withColumn("late", ~cut).repartition(2, "late").drop("late").write.parquet(f"{root}/source"))
    ingest_epochs(spark, f"{root}/source", f"{root}/wh", f"{root}/checkpoint", files_per_epoch=1, buckets=16)
    table = IndexedRaw(spark, f"{root}/wh/raw_usage_indexed")
    first = table.read("epoch-0").drop(LOAD, MONTH)
    load_epoch(Warehouse(spark, f"{root}/wh"), table, first, "epoch-0", False, "replay")
    table.close()
    return table.read().select(ID, "line_item_usage_start_date", PRODUCT, "line_item_usage_type", COST)


def q_variant_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.13: every event as a nested JSON text, some cut short, some with a cost or a
    day of the wrong kind, read by path; valid and rejected rows."""
    n = F.col("event_id")
    day = F.to_date("ts").cast("string")
    cost = (F.when(n % 89 == 3, '"n/a"').when(n % 50 == 7, "null").otherwise(F.col("value").cast("decimal(18,2)").cast("string")))
    text = F.concat(F.lit('{"line": {"id": "'), n.cast("string"), F.lit('", "day": '),
                    F.when(n % 101 == 9, F.lit("{}")).otherwise(F.concat(F.lit('"'), day, F.lit('"'))),
                    F.lit('}, "product": {"code": "'), F.col("event_type"), F.lit('", "types": ["'), F.col("event_type"), F.lit(":"),
                    (n % 3).cast("string"), F.lit('", "x"]}, "cost": '), cost, F.lit("}"))
    rows = V.table(spark, sf_dir, "events").select(
        n, F.when(n % 97 == 5, F.substr(text, F.lit(1), F.length(text) - 9)).otherwise(text).alias("payload"))
    valid, rejected = usage_from_json(rows)
    both = valid.withColumn("problem", F.lit(None).cast("string")).unionByName(rejected)
    return _dbl(both, "cost")


def q_ledger_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of every order as JSON Lines, corrupted by a fixed rule, read
    back: valid entries and rejected lines with their reason."""
    n = F.col("o_orderkey")
    entry = F.to_json(F.struct(
        F.concat(F.lit("E-"), n.cast("string")).alias("evidence_id"),
        F.when(n % 23 != 5, F.concat(F.lit("C-0"), (n % 9).cast("string"))).alias("control_id"),
        F.when(F.col("o_orderstatus") == "F", "pass").otherwise("fail").alias("status"),
        F.when(n % 19 != 4, F.array(F.lit("C-06"))).alias("standard_controls_deferred")))
    line = (F.when(n % 17 == 3, F.substr(entry, F.lit(1), F.length(entry) - 5))
            .when(n % 29 == 7, F.regexp_replace(entry, r'"status":"(\w+)"', '"status":["$1"], "standard_controls_deferred":7'))
            .when(n % 31 == 11, F.concat(F.lit("  "), entry)).otherwise(entry))
    path = scratch_path(spark, "ledger")
    orders = V.table(spark, sf_dir, "orders").select(F.explode(F.when(n % 41 == 1, F.array(line, F.lit(" "))).otherwise(F.array(line))).alias("value"))
    orders.write.text(path)
    got = read_ledger_checked(spark, path)
    none = F.lit(None).cast("string")
    return (got.valid.select("evidence_id", "control_id", "status", F.size("standard_controls_deferred").cast("bigint").alias("deferred"), none.alias("reason"))
            .withColumn("deferred", F.when(F.col("deferred") >= 0, F.col("deferred")))
            .unionByName(got.rejected.select(F.regexp_extract("value", r"E-\d+", 0).alias("evidence_id"), none.alias("control_id"),
                                             none.alias("status"), F.lit(None).cast("bigint").alias("deferred"), "reason")))


def q_customer_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 by customer: the stored fact's rows of the customers whose id 100 divides."""
    raw, ds, dc = _customer_fact(spark, sf_dir)
    path = scratch_path(spark, "lookup")
    write_for_lookup(FA.customer_cost(raw, ds, dc, RUN_TS, by_date=True), path, "customer_key", ["usage_date"], dc.count(), dealt=True)
    fact = spark.read.schema(f"customer_key bigint, service_key bigint, allocated_cost {MONEY_2DP.simpleString()}, "
                             "record_count bigint, null_cost_count bigint, usage_date string").parquet(path)
    wanted = dc.filter(F.col("customer_id") % 100 == 0).select("customer_key")
    return _dbl(lookup(fact, "customer_key", wanted), "allocated_cost")


def q_fact_customer_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6, D1 on a bucketed target: the second run's allocation meets the stored
    first run bucket to bucket."""
    raw = raw_usage(spark, sf_dir)
    ds = materialize(D.load_dim_service(raw, None, RUN_TS))
    cust = V.table(spark, sf_dir, "customer")
    d1 = materialize(D.load_dim_customer(None, V.snapshot_v1(cust), SALT, V.SNAPSHOT_V1_DATE))
    d2 = materialize(D.load_dim_customer(d1, V.snapshot_v2(cust), SALT, V.SNAPSHOT_V2_DATE))
    n = _fact_buckets(raw, ds, d2)
    with bucketed(FA.load_fact_customer_cost(raw, ds, d1, None, "run-1", buckets=n), ["customer_key"], n, dealt=True) as target, dealt_joins(spark):
        source = FA.load_fact_customer_cost(raw, ds, d2, None, "run-2", buckets=n)
        out = upsert_bucketed(target, source, FACT_CUSTOMER_KEYS,
                              ["allocated_cost", "record_count", "null_cost_count", "_loaded_at"], n,
                              check_unique=False, bucket_keys=["customer_key"])
        return _dbl(materialize(out), "allocated_cost")


def q_dq_grain_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on a bucketed fact: no exchange of its rows."""
    raw, ds, dc = _customer_fact(spark, sf_dir)
    n = _fact_buckets(raw, ds, dc)
    with bucketed(FA.customer_cost(raw, ds, dc, RUN_TS, parts=n), ["customer_key"], n, dealt=True) as fact:
        return materialize(QA.grain_check(fact, FACT_CUSTOMER_KEYS, "fact_customer_cost"))


def q_deferred_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 by control, over a ledger with an entry per order: a third are overrides."""
    n = F.col("o_orderkey")
    ledger = V.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("E-"), n.cast("string")).alias("evidence_id"),
        F.when(n % 3 == 0, "C-11").otherwise("C-06").alias("control_id"),
        F.when(n % 5 == 1, "completed").when(n % 7 == 2, "pending").when(n % 1009 == 3, "escalated").alias("remediation_status"),
        F.when(n % 11 != 4, F.array(F.concat(F.lit("C-0"), (n % 4).cast("string")), F.lit("C-06"))).alias("standard_controls_deferred"),
        F.to_date("o_orderdate").cast("string").alias("remediation_deadline"))
    return QA.deferred_controls(ledger)


def q_warehouse_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs into a warehouse, then every derived table
    rebuilt from the raw layer and both snapshots; the customer fact."""
    from costlake.plans.pipeline import Snapshot, rebuild_from_raw, run_pipeline

    root = scratch_path(spark, "warehouse")
    raw, cust = raw_usage(spark, sf_dir), V.table(spark, sf_dir, "customer")
    snaps = [Snapshot(V.snapshot_v1(cust), V.SNAPSHOT_V1_DATE), Snapshot(V.snapshot_v2(cust), V.SNAPSHOT_V2_DATE)]
    for batch, snap in zip(_batches(raw, [FIRST_LOAD_BEFORE]), snaps):
        run_pipeline(spark, root, batch, [snap], SALT, RUN_TS)
    rebuild_from_raw(spark, root, snaps, SALT, RUN_TS)
    return _dbl(Warehouse(spark, root).read("fact_customer_cost"), "allocated_cost").drop("_loaded_at")


QUERIES: dict[str, Query] = {
    "customer_slice": q_customer_slice,
    "fact_customer_upsert_bucketed": q_fact_customer_upsert_bucketed,
    "dq_grain_bucketed": q_dq_grain_bucketed,
    "append_indexed": q_append_indexed,
    "dim_service_incremental": q_dim_service_incremental,
    "scd2_replay": q_scd2_replay,
    "active_pairs_long": q_active_pairs_long,
    "distinct_customers_range": q_distinct_customers_range,
    "stream_ingest": q_stream_ingest,
    "variant_usage": q_variant_usage,
    "ledger_from_files": q_ledger_from_files,
    "daily_cost_summary": q_daily_cost_summary,
    "cost_trend_7": q_cost_trend_7,
    "top_services": q_top_services,
    "month_over_month": q_month_over_month,
    "weekly_anomalies": q_weekly_anomalies,
    "dim_service": q_dim_service,
    "dim_service_reload": q_dim_service_reload,
    "masked_customers": q_masked_customers,
    "snapshot_diff": q_snapshot_diff,
    "dim_customer_scd2": q_dim_customer_scd2,
    "fact_daily_cost": q_fact_daily_cost,
    "fact_daily_upsert": q_fact_daily_upsert,
    "active_customers": q_active_customers,
    "fact_customer_cost": q_fact_customer_cost,
    "customer_cost_timed_dates": q_customer_cost_timed_dates,
    "fact_customer_upsert": q_fact_customer_upsert,
    "segment_cost": q_segment_cost,
    "segment_cost_of_fact": q_segment_cost_of_fact,
    "warehouse_rebuild": q_warehouse_rebuild,
    "deferred_controls": q_deferred_controls,
    "distinct_customers_per_date": q_distinct_customers_per_date,
    "enriched_fact": q_enriched_fact,
    "new_usage_rows": q_new_usage_rows,
    "segment_counts": q_segment_counts,
    "daily_cost_since": q_daily_cost_since,
    "dq_orphans": q_dq_orphans,
    "dq_grain": q_dq_grain,
    "dq_reconcile_counts": q_dq_reconcile_counts,
    "dq_reconcile_cost": q_dq_reconcile_cost,
    "dq_scd2": q_dq_scd2,
    "dq_ranges": q_dq_ranges,
    "dq_pii": q_dq_pii,
    "control_coverage": q_control_coverage,
    "override_status": q_override_status,
    "usage_metrics": q_usage_metrics,
    "duplicate_usage_ids": q_duplicate_usage_ids,
    "dq_orphans_old_dims": q_dq_orphans_old_dims,
    "dq_ranges_faulty": q_dq_ranges_faulty,
    "dq_scd2_faulty": q_dq_scd2_faulty,
    "dq_pii_faulty": q_dq_pii_faulty,
    "dim_service_growth": q_dim_service_growth,
    "top_services_ties": q_top_services_ties,
    "weekly_anomalies_from_zero": q_weekly_anomalies_from_zero,
    "masked_customers_padded": q_masked_customers_padded,
    "usage_metrics_faulty": q_usage_metrics_faulty,
    "control_evidence": q_control_evidence,
}
