"""X1 ``ingest_stream`` and X2 fact refresh.

A file-source stream over the folder where usage exports land; each
micro-batch runs the same keyed append as the batch loader (only ids not yet
in the raw table are written), so a replayed batch after a failure inserts
nothing twice. With ``refresh`` the fact partitions (daily and per customer)
of the dates the batch touched are recomputed from the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from costlake.operators import dims as D
from costlake.operators import facts as FA
from costlake.plans.pipeline import RAW, RAW_PARTITION, raw_path, read_raw
from costlake.session import scratch_scope
from costlake.sources.id_index import DEFAULT_BUCKETS, MONTH, IndexedRaw
from costlake.sources.tables import Warehouse
from costlake.sources.usage import append_new_usage


SERVICE_STATE = "service_state"


def refresh_services(wh: Warehouse, raw: DataFrame, added: DataFrame, run_ts: str) -> None:
    """D2 per batch: the stored observations take in the added lines and give the
    dimension; the history is read only once, where there is no state yet."""
    state = wh.read(SERVICE_STATE)
    wh.replace(SERVICE_STATE, D.merge_service_state(state, raw if state is None else added))
    wh.replace("dim_service", D.dim_service_from(wh.read(SERVICE_STATE), wh.read("dim_service"), run_ts))


def refresh_facts(wh: Warehouse, dates: DataFrame, run_ts: str, raw: DataFrame | None = None,
                  added: DataFrame | None = None) -> None:
    """Recompute both facts for the given usage dates only.

    The raw lines of those dates (a semi join with the distinct dates, which
    prunes the date-partitioned raw scan) feed the same loaders as the batch
    pipeline; each fact then rewrites only those date partitions. With ``added``
    (the lines that the batch brought) the service dimension follows from its state.
    """
    raw = read_raw(wh) if raw is None else raw
    if raw is None:
        return
    # A service first seen in this batch must be known before its facts arrive.
    if added is not None:
        refresh_services(wh, raw, added, run_ts)
    else:
        wh.replace("dim_service", D.load_dim_service(raw, wh.read("dim_service"), run_ts))
    ds = wh.read("dim_service")
    touched = raw.join(dates.select(F.col("line_item_usage_start_date")).distinct(),
                       "line_item_usage_start_date", "left_semi")
    wh.write_partitions("fact_daily_cost", FA.load_fact_daily_cost(
        touched, ds, wh.read("fact_daily_cost"), run_ts, partitions_only=True))
    dc = wh.read("dim_customer")
    if dc is not None:
        wh.write_partitions("fact_customer_cost", FA.load_fact_customer_cost(
            touched, ds, dc, wh.read("fact_customer_cost"), run_ts, partitions_only=True))


def ingest_stream(spark: SparkSession, source_dir: str, root: str, checkpoint_location: str,
                  schema: StructType | None = None, refresh: bool = False, run_ts: str = "stream"):
    """Process every file not yet seen in ``source_dir`` and stop
    (``availableNow``); returns the finished streaming query.

    ``checkpoint_location`` must be on shared storage; it records which
    files were processed.
    """
    wh = Warehouse(spark, root)
    schema = schema or spark.read.parquet(source_dir).schema
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        with scratch_scope(spark):
            append_new_usage(batch, raw_path(wh), partition_by=RAW_PARTITION)
            if refresh:
                refresh_facts(wh, batch.select("line_item_usage_start_date"), run_ts)

    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True)
         .queryName(f"costlake_ingest_{RAW}")
         .start())
    q.awaitTermination()
    return q


def load_epoch(wh: Warehouse, table: IndexedRaw, batch: DataFrame, epoch: str, refresh: bool, run_ts: str) -> int:
    """One micro-batch under the name of its epoch: run again, it inserts nothing
    and leaves every table as it is."""
    with scratch_scope(wh.spark):
        inserted = table.append(batch, epoch).inserted
        if refresh and (raw := table.read()) is not None:
            added = table.read(epoch)     # the batch's source may be what the append replaced
            raw = raw.join(added.select(MONTH).distinct(), MONTH, "left_semi")
            refresh_facts(wh, added.select("line_item_usage_start_date"), run_ts, raw, added)
        return inserted


def ingest_epochs(spark: SparkSession, source_dir: str, root: str, checkpoint_location: str, refresh: bool = False,
                  run_ts: str = "stream", files_per_epoch: int | None = None, buckets: int = DEFAULT_BUCKETS):
    """X1 with an id index: every file not yet seen, in micro-batches whose appends
    carry their epoch. Returns the finished query; its checkpoint must be on shared
    storage, and names the epochs, so one root takes one checkpoint."""
    table = IndexedRaw(spark, f"{root.rstrip('/')}/{RAW}_indexed", buckets)
    wh = Warehouse(spark, root)
    reader = spark.readStream.schema(spark.read.parquet(source_dir).schema)
    if files_per_epoch:
        reader = reader.option("maxFilesPerTrigger", files_per_epoch)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        load_epoch(wh, table, batch, f"epoch-{epoch_id}", refresh, run_ts)

    q = (reader.parquet(source_dir).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
