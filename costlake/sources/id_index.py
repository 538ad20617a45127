"""S4 with an id index: a raw usage table whose appends never read its history.

``IndexedRaw`` keeps two things under one root: the raw lines, in folders of
their load and usage month, and an index of all line ids, bucketed by id with
Spark's own bucketing. A batch's distinct ids meet the index bucket to bucket: only
the batch is shuffled, the index is scanned without an exchange, and the raw
lines are not read at all.

Every load has a name, and an id belongs to the load that brought it first. A
load first claims its new ids in the index, then overwrites its own folder of
lines; so a load that failed anywhere, or is delivered twice, is simply run again
under its name and changes nothing that is already there. A load that was begun must be
run to its end, since later loads leave its ids to it.

The lines themselves move once, to meet the load's ids, and are written to their folders from
there: a task writes a file for each month it holds, and tasks are sized by rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costlake.operators.joins import broadcast_limit, shuffles_for
from costlake.schemas import USAGE_COLUMNS
from costlake.session import materialize
from costlake.sources.tables import _fs, _read_text, _write_text
from costlake.sources.usage import ID, AppendResult, normalize_usage

DEFAULT_BUCKETS = 64
IDS_PER_BUCKET = 4_000_000
MONTH, LOAD = "usage_month", "load_id"
NO_MONTH = "none"               # folder of lines without a start date


class IndexedRaw:
    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        """``buckets`` counts for a new table; an old one keeps its number (size a
        bucket to a task: about 4 million ids)."""
        self.spark, self.root = spark, root.rstrip("/")
        self.lines = f"{self.root}/lines"
        held = _read_text(spark, f"{self.root}/_buckets")
        if held is None:
            _write_text(spark, f"{self.root}/_buckets", str(buckets))
        self.buckets = int(held or buckets)
        self.name = "costlake_ids_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({ID} STRING, {LOAD} STRING) USING parquet "
                  f"CLUSTERED BY ({ID}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/ids'")

    def close(self) -> None:
        """Forget the index's name in the session's catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def ids(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self, load: str | None = None) -> DataFrame | None:
        """The raw lines (of one load), or None before the first one."""
        fs, p = _fs(self.spark, self.lines)
        if not fs.exists(p):
            return None
        kinds = ", ".join(f"{c} string" for c in [*USAGE_COLUMNS, LOAD, MONTH])
        rows = self.spark.read.schema(kinds).parquet(self.lines)
        return rows if load is None else rows.filter(F.col(LOAD) == load)

    def claimable(self, batch: DataFrame, load: str) -> DataFrame:
        """(id, fresh) of the batch's ids that belong to ``load``; ``fresh`` ones are
        not in the index yet. Ids are made distinct before they are dealt to
        the buckets, so an id that fills the batch is one row."""
        asked = (batch.select(F.col(ID)).filter(F.col(ID).isNotNull()).distinct()
                 .repartition(self.buckets, ID))
        met = asked.join(self.ids(), ID, "left")
        return met.filter(F.col(LOAD).isNull() | (F.col(LOAD) == load)).select(ID, F.col(LOAD).isNull().alias("fresh"))

    def append(self, batch: DataFrame, load: str, lines_of: Callable[[DataFrame], DataFrame] | None = None) -> AppendResult:
        """Append the lines whose ids no other load has. Lines that share an id inside
        the batch are all kept; lines without an id are not. ``lines_of`` makes the lines of
        rows that have the id as text and little else: then those rows meet the load's
        ids, and only what is kept of them becomes lines."""
        make = lines_of or (lambda rows: rows)
        ours, m = materialize(self.claimable(normalize_usage(make(batch)), load), {"ids": F.count(F.lit(1)), "fresh": F.count_if("fresh")})
        if m["fresh"]:
            (ours.filter("fresh").select(ID, F.lit(load).alias(LOAD)).repartition(self.buckets, ID)
             .write.insertInto(self.name))
        if not m["ids"]:
            return AppendResult(0, {"inserted": 0, "null_cost": 0, "new_ids": 0})
        few = m["ids"] <= broadcast_limit(self.spark)
        keep = F.broadcast(ours.select(ID)) if few else ours.select(ID)
        start = F.col("line_item_usage_start_date")
        month = F.coalesce(F.nullif(F.substring(start, 1, 7), F.lit("")), F.lit(NO_MONTH))
        # The load's ids meet lines as text, or rows that are not lines yet.
        kept = batch.join(keep, ID, "left_semi") if lines_of else normalize_usage(batch).join(keep, ID, "left_semi")
        out = normalize_usage(make(kept)).select(*USAGE_COLUMNS, F.lit(load).alias(LOAD), month.alias(MONTH))
        if few:
            # Lines of few ids may be left in any number of tasks: gathered by month.
            out = out.hint("rebalance", MONTH)
        # In order of their day, so a reader of few days skips row groups. The batch may read
        # what this replaces: a dynamic overwrite removes old folders when its files are all written.
        obs = Observation(f"append-{uuid.uuid4().hex[:8]}")
        with shuffles_for(self.spark, m["ids"]):
            (out.observe(obs, F.count(F.lit(1)).alias("inserted"),
                         F.count_if(F.col("line_item_unblended_cost").isNull()).alias("null_cost"))
             .sortWithinPartitions(LOAD, MONTH, "line_item_usage_start_date")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(LOAD, MONTH).parquet(self.lines))
        n = dict(obs.get)
        return AppendResult(n["inserted"] if m["fresh"] else 0, {**n, "new_ids": m["fresh"]})
