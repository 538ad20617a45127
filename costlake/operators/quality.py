"""Data-quality and governance checks (Q1-Q9).

Checks return a long frame ``(check_name, violations)`` so several checks come
out of one aggregation pass (``stack`` over one row of ``count_if``s) and
results of different tables can be unioned without joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.schemas import OPEN_END_DATE, OVERRIDE_CONTROL_ID, PHONE_MASK_PREFIX, PII_COLUMN_NAMES


def _long(one_row: DataFrame, names: list[str]) -> DataFrame:
    """One row of named counts -> rows (check_name, violations)."""
    args = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return one_row.select(F.expr(f"stack({len(names)}, {args}) AS (check_name, violations)"))


def _counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    row = df.agg(*[F.coalesce(F.count_if(c), F.lit(0)).alias(n) for n, c in checks.items()])
    return _long(row, list(checks))


# --- Q1 --------------------------------------------------------------------------------

def orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None,
            name: str | None = None) -> DataFrame:
    """Fact rows whose ``key`` has no row in ``dim``.

    The fact is reduced to one row per key first (partial aggregation), so
    the anti join moves distinct keys, not fact rows.
    """
    dim_key = dim_key or key
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    d = dim.select(F.col(dim_key).alias(key)).distinct()
    miss = per_key.join(d, key, "left_anti")
    label = name or f"orphan {key}"
    return miss.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(label).alias("check_name"), "violations")


def referential_integrity(fact_customer: DataFrame, fact_daily: DataFrame,
                          dim_customer: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Q1: orphan counts of every fact foreign key."""
    return (orphans(fact_customer, "customer_key", dim_customer, name="fact_customer_cost.customer_key")
            .unionByName(orphans(fact_customer, "service_key", dim_service, name="fact_customer_cost.service_key"))
            .unionByName(orphans(fact_daily, "service_key", dim_service, name="fact_daily_cost.service_key")))


# --- Q2 (A9, A10) ------------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """A10: ``GROUP BY keys HAVING COUNT(*) > 1``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def grain_check(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Rows, distinct keys and duplicated keys of ``table`` on ``keys``
    (one shuffle on the keys, partial aggregation before it)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
                 F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
                 F.count_if(F.col("n") > 1).cast("bigint").alias("duplicate_keys")).select(
        F.lit(table).alias("table_name"), "row_count", "distinct_keys", "duplicate_keys")


# --- Q3 / Q4 ---------------------------------------------------------------------------------

def reconcile_counts(fact_daily: DataFrame, raw: DataFrame) -> DataFrame:
    """Q3: SUM(record_count) of the daily fact against the raw line count;
    lines of services unknown to the dimension show up as ``unmatched``."""
    a = fact_daily.select(F.col("record_count").cast("bigint").alias("f"), F.lit(0).cast("bigint").alias("r"))
    b = raw.select(F.lit(0).cast("bigint").alias("f"), F.lit(1).cast("bigint").alias("r"))
    t = a.unionByName(b).agg(F.coalesce(F.sum("f"), F.lit(0)).alias("fact_records"),
                             F.coalesce(F.sum("r"), F.lit(0)).alias("raw_rows"))
    return t.select("fact_records", "raw_rows", (F.col("raw_rows") - F.col("fact_records")).alias("unmatched"))


def reconcile_cost(fact_customer: DataFrame, fact_daily: DataFrame, per_customer_tolerance: float = 0.005) -> DataFrame:
    """Q4: allocated total per (date, service) against the daily cost.

    Even split with rounding can drift by at most half a cent per customer,
    so the tolerance is ``customers * per_customer_tolerance``.
    """
    alloc = fact_customer.groupBy("usage_date", "service_key").agg(
        F.sum("allocated_cost").alias("allocated_total"), F.count(F.lit(1)).alias("customers"))
    j = alloc.join(fact_daily.select("usage_date", "service_key", "daily_cost"),
                   ["usage_date", "service_key"], "full_outer")
    diff = F.coalesce(F.col("allocated_total"), F.lit(0)) - F.coalesce(F.col("daily_cost"), F.lit(0))
    tol = F.coalesce(F.col("customers"), F.lit(0)) * F.lit(str(per_customer_tolerance)).cast("decimal(10,6)")
    return j.select("usage_date", "service_key", "allocated_total", "daily_cost",
                    F.coalesce(F.col("customers"), F.lit(0)).cast("bigint").alias("customers"),
                    diff.alias("diff"), (F.abs(diff) <= tol).alias("within_tolerance"))


# --- Q5 -------------------------------------------------------------------------------------

def scd2_integrity(dim_customer: DataFrame) -> DataFrame:
    """Q5: SCD2 invariants in one pass over the dimension (one shuffle on
    customer_id for the per-customer window). A customer gains at most one
    version per snapshot load, so a window group is bounded by the number
    of loads, not by the data volume."""
    w = Window.partitionBy("customer_id").orderBy("effective_from", "customer_key")
    wc = Window.partitionBy("customer_id")
    to = F.coalesce(F.col("effective_to"), F.lit(OPEN_END_DATE))
    d = (dim_customer
         .withColumn("_next_from", F.lead("effective_from").over(w))
         .withColumn("_currents", F.count_if(F.col("is_current")).over(wc))
         .withColumn("_first", F.row_number().over(w) == 1))
    return _counts(d, {
        "multiple_current": F.col("_first") & (F.col("_currents") > 1),
        "no_current": F.col("_first") & (F.col("_currents") == 0),
        "closed_without_end": ~F.col("is_current") & F.col("effective_to").isNull(),
        "current_with_end": F.col("is_current") & F.col("effective_to").isNotNull(),
        "end_before_start": to < F.col("effective_from"),
        "overlapping_versions": F.col("_next_from").isNotNull() & (F.col("_next_from") < to),
        "duplicate_customer_key": F.lit(False),
    }).unionByName(
        grain_check(dim_customer, ["customer_key"], "dim_customer").select(
            F.lit("duplicate_customer_key").alias("check_name"), F.col("duplicate_keys").alias("violations"))
    ).groupBy("check_name").agg(F.sum("violations").cast("bigint").alias("violations"))


# --- Q6 ---------------------------------------------------------------------------------------

def cost_range_checks(fact: DataFrame, cost_col: str) -> DataFrame:
    """Q6: no NULL or negative cost, positive counts, service key present,
    at most 2 decimals."""
    c = F.col(cost_col)
    return _counts(fact, {
        "null_cost": c.isNull(),
        "negative_cost": c < 0,
        "non_positive_record_count": F.col("record_count") <= 0,
        "negative_null_cost_count": F.col("null_cost_count") < 0,
        "null_service_key": F.col("service_key").isNull(),
        "more_than_2dp": c.isNotNull() & (F.round(c, 2) != c),
        "empty_usage_date": F.col("usage_date").isNull() | (F.length("usage_date") == 0),
    })


# --- Q7 ------------------------------------------------------------------------------------------

def pii_leak_check(dim_customer: DataFrame, *facts: DataFrame) -> DataFrame:
    """Q7: masked columns really masked; no PII-named column in any fact."""
    checks = _counts(dim_customer, {
        "email_token_has_at": F.contains(F.col("email_token"), F.lit("@")),
        "email_token_not_sha256_hex": ~F.col("email_token").rlike("^[0-9a-f]{64}$"),
        "phone_not_redacted": ~F.col("phone_redacted").rlike(
            "^" + PHONE_MASK_PREFIX.replace("-", "\\-") + "[0-9]{4}$"),
    })
    leaked = sum(1 for f in facts for c in f.columns if c.lower() in PII_COLUMN_NAMES)
    spark = dim_customer.sparkSession
    schema_row = spark.range(1).select(F.lit("pii_column_in_fact").alias("check_name"),
                                       F.lit(leaked).cast("bigint").alias("violations"))
    return checks.unionByName(schema_row)


# --- Q8 / Q9 -----------------------------------------------------------------------------------

def control_coverage(ledger: DataFrame, required: DataFrame) -> DataFrame:
    """Q8: per required control, SATISFIED when at least one ``pass``
    evidence exists, else MISSING; ``gate_result`` is READY only when all
    are satisfied. ``required`` has one column ``control_id``.

    The evidence ids themselves are in ``control_evidence`` (one row per
    id), so no list is gathered into one row.
    """
    passing = (ledger.filter(F.col("status") == "pass")
               .groupBy("control_id").agg(F.count(F.lit(1)).alias("evidence_count")))
    per = (required.select("control_id").distinct()
           .join(passing, "control_id", "left")
           .select("control_id",
                   F.when(F.col("evidence_count").isNotNull(), F.lit("SATISFIED"))
                   .otherwise(F.lit("MISSING")).alias("status"),
                   F.coalesce(F.col("evidence_count"), F.lit(0)).cast("bigint").alias("evidence_count")))
    all_ok = F.min(F.when(F.col("status") == "SATISFIED", 1).otherwise(0)).over(Window.partitionBy(F.lit(1)))
    return per.withColumn("gate_result", F.when(all_ok == 1, F.lit("READY")).otherwise(F.lit("BLOCKED")))


def control_evidence(ledger: DataFrame, required: DataFrame) -> DataFrame:
    """Q8 detail: (control_id, evidence_id) of the passing evidence of required controls."""
    return (ledger.filter(F.col("status") == "pass")
            .join(required.select("control_id").distinct(), "control_id", "left_semi")
            .select("control_id", "evidence_id"))


def override_status(ledger: DataFrame) -> DataFrame:
    """Q9: emergency overrides (control C-11): none -> CLEAN, all remediation
    ``completed`` -> REMEDIATED, any ``escalated`` -> ESCALATED, else PENDING.
    One row: overrides_found, status."""
    rs = F.coalesce(F.col("remediation_status"), F.lit("unknown"))
    o = ledger.filter(F.col("control_id") == OVERRIDE_CONTROL_ID)
    agg = o.agg(F.count(F.lit(1)).alias("overrides_found"),
                F.coalesce(F.bool_and(rs == "completed"), F.lit(True)).alias("_all_done"),
                F.coalesce(F.bool_or(rs == "escalated"), F.lit(False)).alias("_any_esc"))
    status = (F.when(F.col("overrides_found") == 0, F.lit("CLEAN"))
              .when(F.col("_all_done"), F.lit("REMEDIATED"))
              .when(F.col("_any_esc"), F.lit("ESCALATED"))
              .otherwise(F.lit("PENDING")))
    return agg.select(F.col("overrides_found").cast("bigint"), status.alias("status"))


def deferred_controls(ledger: DataFrame) -> DataFrame:
    """Q9 by control: which controls open overrides (not ``completed``) put off, how many
    of them do, whether any is escalated, and the first deadline."""
    still_open = ledger.filter((F.col("control_id") == OVERRIDE_CONTROL_ID)
                               & ~F.coalesce(F.col("remediation_status") == "completed", F.lit(False)))
    each = still_open.select("evidence_id", "remediation_status", "remediation_deadline",
                             F.explode(F.array_distinct("standard_controls_deferred")).alias("control_id"))
    return each.groupBy("control_id").agg(
        F.count(F.lit(1)).alias("open_overrides"),
        F.coalesce(F.bool_or(F.col("remediation_status") == "escalated"), F.lit(False)).alias("escalated"),
        F.min("remediation_deadline").alias("first_deadline"))
