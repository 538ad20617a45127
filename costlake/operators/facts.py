"""Facts: daily cost per service (D5) and cost allocated to customers.

J1 ``lookup_service_key``, A2 ``service_daily``, J2 ``active_pairs``,
A4 ``active_customers_per_date``, J3/D6 ``customer_cost``, A7, A8, J4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.functions.money import allocate_even, cost_or_zero, round_money
from costlake.operators.joins import broadcast_limit, salted_join, tasks_for
from costlake.operators.upsert import upsert, upsert_partitions
from costlake.session import materialize
from costlake.schemas import FACT_CUSTOMER_COLUMNS, FACT_DAILY_COLUMNS, MONEY_2DP, MONEY_SUM, OPEN_END_DATE


# --- A2 / J1 -------------------------------------------------------------------------------

def service_daily(raw: DataFrame, dim_service: DataFrame) -> DataFrame:
    """A2 + J1: per (usage_date, service_key) the cost rounded to 2 dp, the line
    count and the NULL-cost count.

    Aggregates first (partial + final hash aggregate on date, product and
    usage type), then looks the service key up in ``dim_service`` (inner
    join: NULL keys and unknown services drop out). The dimension join is
    left to the planner's size check: broadcast when the dimension's file
    statistics are under ``spark.sql.autoBroadcastJoinThreshold``, or when
    AQE sees its real shuffle size under the adaptive threshold; otherwise a
    sort-merge join. (product_code, usage_type) is unique in ``dim_service``,
    so no second aggregation is needed.
    """
    cost = F.col("line_item_unblended_cost")
    pre = (raw.groupBy(F.col("line_item_usage_start_date").alias("usage_date"),
                       F.col("line_item_product_code").alias("product_code"),
                       F.col("line_item_usage_type").alias("usage_type"))
           .agg(F.sum(cost_or_zero(cost)).cast(MONEY_SUM).alias("_cost"),
                F.count(F.lit(1)).alias("record_count"),
                F.count_if(cost.isNull()).alias("null_cost_count")))
    dim = dim_service.select("product_code", "usage_type", "service_key")
    j = pre.join(dim, ["product_code", "usage_type"], "inner")
    return j.select("usage_date", F.col("service_key").cast("bigint").alias("service_key"),
                    round_money("_cost", 2).cast(MONEY_2DP).alias("daily_cost"),
                    "record_count", "null_cost_count")


def load_fact_daily_cost(raw: DataFrame, dim_service: DataFrame, existing: DataFrame | None,
                         run_ts: str, partitions_only: bool = False, service_day: DataFrame | None = None) -> DataFrame:
    """service_daily upserted on (usage_date, service_key).

    With ``partitions_only`` the result holds only the dates the new data
    touches (for dynamic partition overwrite); otherwise the whole table.
    ``service_day`` is ``service_daily`` of these inputs where it is at hand.
    """
    src = (service_daily(raw, dim_service) if service_day is None else service_day).withColumn("_loaded_at", F.lit(run_ts)).select(*FACT_DAILY_COLUMNS)
    if existing is None:
        return src
    upd = ["daily_cost", "record_count", "null_cost_count", "_loaded_at"]
    keys = ["usage_date", "service_key"]
    tgt = existing.select(*FACT_DAILY_COLUMNS)
    # src is an aggregate (or a join of aggregates) keyed by ``keys``: unique by construction
    if partitions_only:
        return upsert_partitions(tgt, src, keys, upd, "usage_date", check_unique=False)
    return upsert(tgt, src, keys, upd, check_unique=False)


# --- J2 / A4 -------------------------------------------------------------------------------

def _valid_versions(dim_customer: DataFrame, *more: str) -> DataFrame:
    to = F.coalesce(F.col("effective_to"), F.lit(OPEN_END_DATE))
    return (dim_customer.select("customer_key", "effective_from", to.alias("_to"), *more)
            .filter(F.col("_to") >= F.col("effective_from")))


def active_customers_per_date(dim_customer: DataFrame, dates: DataFrame) -> DataFrame:
    """A4: number of customer versions active on each date of ``dates``
    (half-open ``effective_from <= d < effective_to``); dates with no active
    customer are left out.

    Sweep instead of fan-out: +1 at every ``effective_from``, -1 at every
    closing ``effective_to``, summed per date (partial aggregation; one row
    per load date), then a running sum over those dates and the usage dates.
    That frame has one row per distinct date, bounded by the calendar, so the
    window may run in one task.
    """
    v = _valid_versions(dim_customer)
    deltas = (v.select(F.col("effective_from").alias("d"), F.lit(1).alias("delta"))
              .unionByName(v.filter(F.col("_to") != OPEN_END_DATE)
                           .select(F.col("_to").alias("d"), F.lit(-1).alias("delta")))
              .groupBy("d").agg(F.sum("delta").alias("delta"), F.lit(0).alias("is_usage")))
    probes = dates.select(F.col("usage_date").alias("d")).distinct().select(
        "d", F.lit(0).cast("bigint").alias("delta"), F.lit(1).alias("is_usage"))
    w = Window.orderBy("d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = deltas.unionByName(probes).withColumn("active_count", F.sum("delta").over(w))
    return (swept.filter((F.col("is_usage") == 1) & (F.col("active_count") > 0))
            .select(F.col("d").alias("usage_date"), F.col("active_count").cast("bigint")))


MAX_LISTED_DATES = 20_000       # distinct date texts that become one array


def active_pairs(dim_customer: DataFrame, dates: DataFrame, max_dates: int | None = None,
                 parts: int | None = None) -> DataFrame:
    """(usage_date, customer_key) for every version active on a date of ``dates``.

    Dates are compared as text (``effective_from <= d < effective_to``), so one
    with a time part belongs to its day, and a version's dates are one run of the
    sorted date texts. Those texts make one array, and every distinct bound of a
    version gets its position in it once (``_positions``; broadcast, bounded
    by the calendar). A version looks up its two bounds and takes the slice
    between them, so it costs its output, however long the history. ``max_dates`` is a
    known bound on the distinct dates (counted here if absent); beyond
    ``MAX_LISTED_DATES`` texts the array holds their days (first ten characters),
    which then meet the texts by an equi join, and the exact comparison follows.

    Versions are dealt by ``customer_key`` over ``parts`` tasks before they fan out (by
    default as many as the pairs need, which the sweep of
    ``active_customers_per_date`` counts without making them), and the result
    stays dealt so: groups and joins on the customer need no exchange of it.
    ``customer_key`` is the dimension's primary key, so the pairs are
    distinct without a DISTINCT (U1; Q2 checks the key).
    """
    spark = dim_customer.sparkSession
    d = dates.select("usage_date").filter(F.col("usage_date").isNotNull()).distinct()
    if max_dates is None:
        max_dates = d.count()
    if parts is None:
        parts = tasks_for(spark, active_customers_per_date(dim_customer, d).agg(F.sum("active_count")).first()[0] or 0)
    listed = max_dates <= MAX_LISTED_DATES
    d = d.withColumn("_day", F.col("usage_date") if listed else _day("usage_date"))
    days = d.agg(F.array_sort(F.collect_set("_day"))).scalar()
    cut = F.col if listed else _day
    v = _valid_versions(dim_customer).select("customer_key", "effective_from", "_to",
                                             cut("effective_from").alias("_a"), cut("_to").alias("_b"))
    at = _positions(v, d)
    low = F.broadcast(at.select(F.col("_day").alias("_a"), F.col("before").alias("low")))
    # A listed text is the date itself, and _to is past the last one; a day may hold dates before _to.
    high = F.broadcast(at.select(F.col("_day").alias("_b"), F.col("before" if listed else "upto").alias("high")))
    placed = v.repartition(parts, "customer_key").join(low, "_a").join(high, "_b").filter(F.col("high") > F.col("low"))
    spans = placed.select("customer_key", "effective_from", "_to", F.explode(
        F.slice(days, F.col("low") + 1, F.col("high") - F.col("low"))).alias("_day"))
    if listed:
        return spans.select(F.col("_day").alias("usage_date"), "customer_key")
    if max_dates <= broadcast_limit(spark):
        d = F.broadcast(d)
    return (spans.join(d, "_day", "inner")
            .filter((F.col("effective_from") <= F.col("usage_date")) & (F.col("usage_date") < F.col("_to")))
            .select("usage_date", "customer_key"))


def _day(c: str) -> Column:
    return F.substring(F.col(c), 1, 10)


def _positions(versions: DataFrame, dates: DataFrame) -> DataFrame:
    """(_day, before, upto): for each bound of a version, how many of the distinct days
    (or listed texts) of ``dates`` lie before it, and how many up to it. One row
    per distinct day, bounded by the calendar, so the running count may use one task."""
    bounds = versions.select(F.explode(F.array("_a", "_b")).alias("_day"), F.lit(0).alias("hit"), F.lit(1).alias("asked"))
    days = dates.select("_day", F.lit(1).alias("hit"), F.lit(0).alias("asked"))
    each = bounds.unionByName(days).groupBy("_day").agg(F.max("hit").alias("hit"), F.max("asked").alias("asked"))
    upto = F.sum("hit").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (each.withColumn("upto", upto.cast("int")).withColumn("before", F.col("upto") - F.col("hit"))
            .filter("asked = 1").select("_day", "before", "upto"))


# --- J3 / D6 -------------------------------------------------------------------------------

def allocation_per_service_day(sd: DataFrame, counts: DataFrame) -> DataFrame:
    """Cost share per (date, service): ``ROUND(daily_cost / active_count, 2)``.

    Computed once per service-day, before the fan-out to customers.
    """
    return (sd.join(counts, "usage_date", "inner")
            .select("usage_date", "service_key",
                    allocate_even("daily_cost", "active_count").alias("allocated_cost"),
                    "record_count", "null_cost_count", "active_count"))


def materialized_service_daily(raw: DataFrame, dim_service: DataFrame) -> tuple[DataFrame, dict]:
    """``service_daily`` written once to the checkpoint folder, with its row
    count observed on the same write (for size checks)."""
    return materialize(service_daily(raw, dim_service), {"rows": F.count(F.lit(1))})


def customer_shares(service_day: DataFrame, dim_customer: DataFrame) -> tuple[DataFrame, int]:
    """The shares per service-day (materialised), and how many rows the customer fact
    has: every share goes to each customer active that day."""
    counts = active_customers_per_date(dim_customer, service_day)
    alloc, made = materialize(allocation_per_service_day(service_day, counts), {"rows": F.sum("active_count")})
    return alloc, int(made["rows"] or 0)


def customer_cost(raw: DataFrame, dim_service: DataFrame, dim_customer: DataFrame, run_ts: str,
                  service_day: tuple[DataFrame, dict] | None = None, by_date: bool = False,
                  shares: tuple[DataFrame, int] | None = None, parts: int | None = None) -> DataFrame:
    """D6 source rows: each service-day's cost split evenly over the customers
    active that day. ``record_count`` and ``null_cost_count`` are copied to
    every customer, not split.

    Plan: service_daily (one aggregate over raw, materialised: it is small and
    read three times) -> active counts by sweep -> share per service-day
    (materialised, and with it the number of fact rows) -> join
    with the active (date, customer) pairs on the date. The share frame
    (dates x services) is broadcast when it passes the size check, so the
    fact rows are never shuffled: they are made, in as many tasks as their number
    needs (or ``parts``), where their customer was dealt; with ``by_date`` the pairs are first
    ranged by date and customer, for a writer of date folders. Beyond the check the
    join is salted by customer so a date holding a third of all rows is
    split across tasks.
    """
    spark = raw.sparkSession
    sd, st = service_day or materialized_service_daily(raw, dim_service)
    alloc, fact_rows = shares or customer_shares(sd, dim_customer)
    parts = parts or tasks_for(spark, fact_rows)
    pairs = active_pairs(dim_customer, sd, int(st["rows"]), parts)
    # alloc has at most one row per service-day row: its bound is sd's count.
    if int(st["rows"]) <= broadcast_limit(spark):
        if by_date:
            pairs = (pairs.repartitionByRange(parts, "usage_date", "customer_key")
                     .sortWithinPartitions("usage_date", "customer_key"))
        fact = pairs.join(F.broadcast(alloc), "usage_date", "inner")
    else:
        fact = salted_join(pairs, alloc, ["usage_date"], F.col("customer_key"))
    return fact.select("usage_date", F.col("customer_key").cast("bigint").alias("customer_key"),
                       "service_key", "allocated_cost", "record_count", "null_cost_count",
                       F.lit(run_ts).alias("_loaded_at"))


def load_fact_customer_cost(raw: DataFrame, dim_service: DataFrame, dim_customer: DataFrame,
                            existing: DataFrame | None, run_ts: str, partitions_only: bool = False,
                            by_date: bool = False, buckets: int | None = None) -> DataFrame:
    """customer_cost upserted on (usage_date, customer_key, service_key).

    The source rows are where their customer was dealt, so an upsert moves only the
    target to them, and not even that if it is stored in ``buckets`` by
    ``customer_key``. ``by_date`` (see ``customer_cost``) is for a first load.

    Stale rows (a customer no longer active on a date) survive the upsert,
    as in the reference; ``rebuild`` in the pipeline is the cure.
    """
    sd, st = materialized_service_daily(raw, dim_service)
    shares = customer_shares(sd, dim_customer)
    parts = buckets or tasks_for(raw.sparkSession, shares[1])
    src = customer_cost(raw, dim_service, dim_customer, run_ts, (sd, st), by_date and existing is None,
                        shares, parts).select(*FACT_CUSTOMER_COLUMNS)
    if existing is None:
        return src
    dealt = int(st["rows"]) <= broadcast_limit(raw.sparkSession)      # see customer_cost
    keys = ["usage_date", "customer_key", "service_key"]
    upd = ["allocated_cost", "record_count", "null_cost_count", "_loaded_at"]
    tgt = existing.select(*FACT_CUSTOMER_COLUMNS)
    if dealt and buckets is None:
        tgt = tgt.repartition(parts, "customer_key")
    # src is an aggregate (or a join of aggregates) keyed by ``keys``: unique by construction
    if partitions_only:
        # The dates come from the service-days, so the pairs are built once and
        # the target is pruned by a broadcast, not shuffled by its date.
        touched = sd.select("usage_date").distinct()
        if dealt:
            touched = F.broadcast(touched)
        return upsert_partitions(tgt, src, keys, upd, "usage_date", check_unique=False, touched=touched, hash_source=dealt)
    return upsert(tgt, src, keys, upd, check_unique=False, hash_source=dealt)


# --- A7 / A8 / J4 --------------------------------------------------------------------------

def segment_cost(fact_customer: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Allocated cost per customer segment, 2 dp.

    The fact is first reduced to one row per customer key (partial
    aggregation), so the join with the dimension moves customers, not
    fact rows.
    """
    per_key = fact_customer.groupBy("customer_key").agg(F.sum("allocated_cost").alias("_c"))
    j = per_key.join(dim_customer.select("customer_key", "segment"), "customer_key", "inner")
    return j.groupBy("segment").agg(round_money(F.sum("_c"), 2).cast(MONEY_2DP).alias("total_cost"))


def segment_cost_by_counts(raw: DataFrame, dim_service: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """A7 without the customer fact: a date's share goes to each of its active
    customers, so a segment costs the share times its active customers.

    The sweep of ``active_customers_per_date`` runs per segment; no pair of a date
    and a customer is ever made. Rows: dates x segments, and service-days."""
    sd, _ = materialized_service_daily(raw, dim_service)
    v = _valid_versions(dim_customer, "segment")
    deltas = (v.select("segment", F.col("effective_from").alias("d"), F.lit(1).alias("delta"))
              .unionByName(v.filter(F.col("_to") != OPEN_END_DATE)
                           .select("segment", F.col("_to").alias("d"), F.lit(-1).alias("delta")))
              .groupBy("segment", "d").agg(F.sum("delta").alias("delta"), F.lit(0).alias("is_usage")))
    # Every segment on every usage date: the segments are one small array.
    names = v.agg(F.collect_set(F.struct("segment"))).scalar()
    probes = (sd.select(F.col("usage_date").alias("d")).distinct().withColumn("s", F.explode(names))
              .select(F.col("s.segment").alias("segment"), "d", F.lit(0).cast("bigint").alias("delta"), F.lit(1).alias("is_usage")))
    w = Window.partitionBy("segment").orderBy("d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    active = (deltas.unionByName(probes).withColumn("active", F.sum("delta").over(w))
              .filter("is_usage = 1 AND active > 0").select("segment", F.col("d").alias("usage_date"), "active"))
    alloc = allocation_per_service_day(sd, active_customers_per_date(dim_customer, sd))
    per_day = alloc.groupBy("usage_date").agg(F.sum("allocated_cost").alias("share"))
    cents = F.sum((F.col("share") * 100).cast("decimal(38,0)") * F.col("active").cast("decimal(18,0)"))
    return (active.join(per_day, "usage_date").groupBy("segment")
            .agg((cents.cast("decimal(36,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY_2DP).alias("total_cost")))


def distinct_customers_per_date(fact_customer: DataFrame) -> DataFrame:
    """COUNT(DISTINCT customer_key) per date."""
    return fact_customer.groupBy("usage_date").agg(F.countDistinct("customer_key").alias("customers"))


SKETCH_LG_K = 16        # 2^16 registers, a standard error of 0.4 %


def distinct_sketches(rows: DataFrame, what: str, by: str = "usage_date", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A8, mergeable: one HyperLogLog sketch of ``what`` per ``by``. Stored by date, the
    sketches of any range are unioned without the rows behind them."""
    return rows.groupBy(by).agg(F.hll_sketch_agg(what, F.lit(lg_k)).alias("sketch"))


def distinct_in_ranges(sketches: DataFrame, ranges: DataFrame, by: str = "usage_date") -> DataFrame:
    """About how many distinct values each range (``range_start`` <= date <
    ``range_end``, ISO text) holds, from the sketches of its dates alone. A range is
    spelt out in its days (bounded by the calendar) and meets the dates by an
    equi join."""
    last = F.date_sub(F.to_date("range_end"), 1)
    days = ranges.filter(last >= F.to_date("range_start")).select(
        "range_start", "range_end", F.explode(F.sequence(F.to_date("range_start"), last)).alias("_day"))
    days = days.select("range_start", "range_end", F.col("_day").cast("string").alias(by))
    return (sketches.join(days, by).groupBy("range_start", "range_end")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("customers")))


def enrich_daily_fact(fact_daily: DataFrame, dim_service: DataFrame) -> DataFrame:
    """Daily fact with the service attributes (the planner's size check
    decides the broadcast of the dimension, as in ``service_daily``)."""
    dim = dim_service.select("service_key", "product_code", "usage_type", "service_category")
    return fact_daily.join(dim, "service_key", "inner")
