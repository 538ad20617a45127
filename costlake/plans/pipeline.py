"""D8 ``run_pipeline`` and D9 ``rebuild_from_raw``: the daily order of steps
over one warehouse folder. Every step reads the current tables, runs a pure
DataFrame function and writes a new table version (or the touched fact
partitions), so each step can be retried on its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.operators import dims as D
from costlake.operators import facts as FA
from costlake.operators import summary as S
from costlake.operators.joins import dealt_joins
from costlake.session import scratch_scope
from costlake.sources.tables import Warehouse, _fs
from costlake.sources.usage import append_new_usage, normalize_usage, read_raw_table, read_usage

RAW = "raw_usage"
RAW_PARTITION = "line_item_usage_start_date"


@dataclass
class Snapshot:
    """A customer snapshot and the date it describes."""
    df: DataFrame
    snapshot_date: str


@dataclass
class PipelineResult:
    inserted: int
    counts: dict[str, int] = field(default_factory=dict)
    summary: DataFrame | None = None


def raw_path(wh: Warehouse) -> str:
    return f"{wh.root}/{RAW}"


def read_raw(wh: Warehouse) -> DataFrame | None:
    fs, p = _fs(wh.spark, raw_path(wh))
    if not fs.exists(p):
        return None
    return read_raw_table(wh.spark, raw_path(wh))


DIM_CUSTOMER_PARTITIONS = ["is_current", "effective_to"]


def load_customer_snapshot(wh: Warehouse, snap: Snapshot, salt: str) -> None:
    """One SCD2 load. The table is partitioned by (is_current, effective_to):
    the load rewrites the current slice and the closed-history partition of
    its own date (with the rows already closed on that date), nothing else."""
    dim = wh.read("dim_customer")
    history, changed = D.scd2_changes(dim, snap.df, salt, snap.snapshot_date)
    if history is None:
        wh.replace("dim_customer", changed, DIM_CUSTOMER_PARTITIONS)
        return
    same_day = history.filter(F.col("effective_to") == snap.snapshot_date)
    wh.write_partitions("dim_customer", changed.unionByName(same_day), DIM_CUSTOMER_PARTITIONS)


def load_dimensions(wh: Warehouse, raw: DataFrame, snapshots: list[Snapshot], salt: str, run_ts: str) -> None:
    wh.replace("dim_service", D.load_dim_service(raw, wh.read("dim_service"), run_ts))
    for snap in sorted(snapshots, key=lambda s: s.snapshot_date):
        load_customer_snapshot(wh, snap, salt)


def load_facts(wh: Warehouse, raw: DataFrame, run_ts: str) -> None:
    ds, dc = wh.read("dim_service"), wh.read("dim_customer")
    wh.write_partitions("fact_daily_cost",
                        FA.load_fact_daily_cost(raw, ds, wh.read("fact_daily_cost"), run_ts, partitions_only=True))
    if dc is not None:
        held = wh.read("fact_customer_cost")
        fact = FA.load_fact_customer_cost(raw, ds, dc, held, run_ts, partitions_only=True, by_date=True)
        with dealt_joins(wh.spark):
            wh.write_partitions("fact_customer_cost", fact, dealt=held is None)


def touched_dates(raw: DataFrame, batch: DataFrame, snapshots: list[Snapshot], first_run: bool) -> DataFrame | None:
    """Usage dates whose facts can change in this run: the dates of the new
    batch, and every date on or after the earliest snapshot loaded (a new or
    closed customer version changes the allocation from its snapshot date
    on). ``None`` means every date (first run). One row per date: bounded by
    the calendar."""
    if first_run:
        return None
    d = F.col(RAW_PARTITION)
    dates = batch.select(d).filter(d.isNotNull())
    if snapshots:
        earliest = min(s.snapshot_date for s in snapshots)
        dates = dates.unionByName(raw.select(d).filter(d >= earliest))
    return dates.distinct()


def run_pipeline(spark: SparkSession, root: str, usage_path: str | DataFrame, snapshots: list[Snapshot],
                 salt: str, run_ts: str, incremental: bool = True) -> PipelineResult:
    """Ingest -> dimensions -> facts; returns insert count, table sizes and
    the (lazy, unpersisted) daily summary.

    With ``incremental`` the facts are recomputed only for ``touched_dates``;
    every other date's inputs are unchanged, so its fact rows would come out
    the same (the reference re-runs everything). The service dimension still
    aggregates the whole raw table, as first/last-seen dates need.
    """
    wh = Warehouse(spark, root)
    # A fact that an earlier run did not reach is loaded for every date.
    first_run = not wh.exists("fact_daily_cost") or (
        wh.exists("dim_customer") and not wh.exists("fact_customer_cost"))
    batch = read_usage(spark, usage_path) if isinstance(usage_path, str) else usage_path
    with scratch_scope(spark):     # every table is written when it ends
        res = append_new_usage(batch, raw_path(wh), partition_by=RAW_PARTITION)
        raw = read_raw(wh)
        load_dimensions(wh, raw, snapshots, salt, run_ts)
        dates = touched_dates(raw, normalize_usage(batch), snapshots, first_run or not incremental)
        fact_input = raw if dates is None else raw.join(dates, RAW_PARTITION, "left_semi")
        load_facts(wh, fact_input, run_ts)
    counts = {t: wh.read(t).count() for t in ("dim_service", "dim_customer", "fact_daily_cost", "fact_customer_cost")
              if wh.exists(t)}
    counts[RAW] = raw.count()
    return PipelineResult(res.inserted, counts, S.daily_cost_summary(raw))


def rebuild_from_raw(spark: SparkSession, root: str, snapshots: list[Snapshot], salt: str, run_ts: str) -> None:
    """Drop every derived table and rebuild it from the raw layer. Snapshots of
    different dates become the customer dimension in one pass; with a date given
    twice they are loaded one after the other, in date order. Removes stale fact
    rows that upserts keep."""
    wh = Warehouse(spark, root)
    for t in ("dim_service", "dim_customer", "fact_daily_cost", "fact_customer_cost", "service_state"):
        wh.drop(t)
    raw = read_raw(wh)
    with scratch_scope(spark):
        if snapshots and len({s.snapshot_date for s in snapshots}) == len(snapshots):
            dated = [s.df.withColumn("snapshot_date", F.lit(s.snapshot_date)) for s in snapshots]
            every = reduce(lambda a, b: a.unionByName(b), dated)
            wh.replace("dim_customer", D.replay_snapshots(every, salt), DIM_CUSTOMER_PARTITIONS)
            snapshots = []
        load_dimensions(wh, raw, snapshots, salt, run_ts)
        load_facts(wh, raw, run_ts)


def drop_raw_dates(spark: SparkSession, root: str, start: str, end: str) -> int:
    """D9 reprocess: remove raw lines with usage dates in [start, end) so a
    reload can bring them back. The raw layer is partitioned by usage date,
    so this deletes whole date folders (a metadata operation); the number of
    removed lines is counted first with a partition-pruned scan."""
    wh = Warehouse(spark, root)
    raw = read_raw(wh)
    if raw is None:
        return 0
    d = F.col(RAW_PARTITION)
    removed = raw.filter((d >= start) & (d < end)).count()
    fs, p = _fs(spark, raw_path(wh))
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(RAW_PARTITION + "="):
            value = unquote(name.split("=", 1)[1])
            if start <= value < end:
                fs.delete(st.getPath(), True)
    return removed
