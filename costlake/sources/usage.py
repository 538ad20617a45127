"""Usage (cost and usage report) ingest: S1-S5, S7 and run metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costlake.functions.money import cost_or_zero, money
from pyspark.sql.types import StringType, StructField, StructType

from costlake.schemas import LEDGER_SCHEMA, RAW_USAGE_SCHEMA, SNAPSHOT_SCHEMA, USAGE_COLUMNS
from costlake.session import materialize

ID = "identity_line_item_id"


def _exists(spark: SparkSession, path: str) -> bool:
    """Path check through the Hadoop file system of the session (works for
    object stores and HDFS, not only local disks)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(jpath))


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Read usage Parquet (file, folder or glob); a missing path raises
    before anything is written."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"usage Parquet not found: {path}")
    return spark.read.parquet(path)


@dataclass(frozen=True)
class ColumnFinding:
    """A required column that a frame does not have as such: ``absent``, or
    ``spelling`` if only its letter case differs."""
    name: str
    problem: str
    found: str | None = None


def usage_schema_findings(actual: StructType, required: StructType = RAW_USAGE_SCHEMA) -> list[ColumnFinding]:
    """The required columns that ``actual`` lacks, in their order. Kinds are free (every
    value becomes text), and so are further columns."""
    by_case = {f.name.lower(): f.name for f in actual}
    exact = frozenset(actual.names)
    return [ColumnFinding(f.name, "spelling" if (near := by_case.get(f.name.lower())) else "absent", near)
            for f in required if f.name not in exact]


# The two messages of a failed check.
NO_COLUMNS = "DataFrame has no columns"
MISSING_COLUMNS = "Missing required columns: {}"


def validate_usage_schema(df: DataFrame) -> list[str]:
    """What is wrong with a usage frame's columns, as messages; none if valid."""
    if not df.schema.fields:
        return [NO_COLUMNS]
    findings = usage_schema_findings(df.schema)
    return [MISSING_COLUMNS.format(", ".join(f.name for f in findings))] if findings else []


def normalize_usage(df: DataFrame) -> DataFrame:
    """S3: the 14 usage columns in fixed order, every value as text."""
    errors = validate_usage_schema(df)
    if errors:
        raise ValueError(f"usage schema validation failed: {'; '.join(errors)}")
    # one projection built in the JVM (a single call instead of one per expression)
    return df.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in USAGE_COLUMNS])


def new_usage_rows(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """S4 (rows part): batch rows whose id is not yet in ``existing``.

    Duplicates inside the batch are all kept (the key is checked against
    the table only). Rows with a NULL id are dropped.

    A batch is usually far smaller than the accumulated table. The batch's
    distinct ids are written once and counted; within the broadcast limit
    the table's id column is probed against them map-side (broadcast semi
    join), which leaves only the table ids that also occur in the batch (at
    most the batch's id count), and the batch is anti-joined with those,
    broadcast too: the table's ids are scanned but never shuffled. Beyond
    the limit, the table's ids are made distinct (partial aggregation) and
    anti-joined by a shuffle on the id, where AQE splits a skewed id.
    """
    from costlake.operators.joins import broadcast_limit

    rows = normalize_usage(batch).filter(F.col(ID).isNotNull())
    if existing is None:
        return rows
    table_ids = existing.select(ID).filter(F.col(ID).isNotNull())
    batch_ids, st = materialize(rows.select(ID).distinct(), {"rows": F.count(F.lit(1))})
    if int(st["rows"]) <= broadcast_limit(batch.sparkSession):
        seen = table_ids.join(F.broadcast(batch_ids), ID, "left_semi").distinct()
        return rows.join(F.broadcast(seen), ID, "left_anti")
    return rows.join(table_ids.distinct(), ID, "left_anti")


@dataclass
class AppendResult:
    inserted: int
    metrics: dict = field(default_factory=dict)


def read_raw_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The raw layer, read with its fixed all-text schema: a partition folder
    such as ``line_item_usage_start_date=2025-01-01`` is taken as text, never
    inferred as a date."""
    return spark.read.schema(RAW_USAGE_SCHEMA).parquet(table_path).select(*USAGE_COLUMNS)


def append_new_usage(batch: DataFrame, table_path: str, partition_by: str | None = None) -> AppendResult:
    """Append the new rows of ``batch`` to the raw table at ``table_path``.

    Lines without an id cannot be keyed: they are set aside, and their number
    and cost are in the metrics (``null_id``, ``null_id_cost``).

    Re-running with the same batch inserts 0. The count comes from an
    ``Observation`` on the written rows; only the lines without an id are
    counted by a pass of their own, over two columns of the batch. With
    ``partition_by`` (e.g. the usage start date) the table is written in
    one folder per value; a ``rebalance`` hint lets AQE split a value that
    holds most of the batch and merge small ones before the write.
    """
    spark = batch.sparkSession
    existing = read_raw_table(spark, table_path) if _exists(spark, table_path) else None
    no_id = F.col(ID).isNull()
    aside = normalize_usage(batch).agg(
        F.count_if(no_id).alias("null_id"),
        F.coalesce(F.sum(F.when(no_id, cost_or_zero("line_item_unblended_cost"))), F.lit(0)).alias("null_id_cost")).first()
    rows = new_usage_rows(batch, existing)
    if partition_by:
        rows = rows.hint("rebalance", partition_by)
    obs = Observation("append_new_usage")
    observed = rows.observe(
        obs,
        F.count(F.lit(1)).alias("inserted"),
        F.count_if(F.col("line_item_unblended_cost").isNull()).alias("null_cost"),
    )
    w = observed.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(table_path)
    m = {**aside.asDict(), **obs.get}
    return AppendResult(inserted=int(m.get("inserted", 0)), metrics=m)


def read_customer_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A full customer snapshot with its fixed schema."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"customer snapshot not found: {path}")
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Evidence ledger in JSON Lines; blank lines skipped, a missing file
    gives an empty frame with the ledger schema."""
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return (spark.read.schema(LEDGER_SCHEMA).option("mode", "FAILFAST").json(path)
            .filter(~(F.col("evidence_id").isNull() & F.col("control_id").isNull()
                      & F.col("status").isNull())))


@dataclass
class LedgerRead:
    valid: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def read_ledger_checked(spark: SparkSession, path: str) -> LedgerRead:
    """S7 with bad lines set aside: a line that is no JSON, has a field of the wrong
    kind, or lacks its evidence or control id goes to ``rejected`` (its text and the
    reason); blank lines are skipped. The parsed lines are stored once and
    counted on the way."""
    kinds = StructType([*LEDGER_SCHEMA.fields, StructField("_bad", StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.from_json("value", kinds, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e"))
    reason = (F.when(F.col("e").isNull() | F.col("e._bad").isNotNull(), "not a ledger entry")
              .when(F.col("e.evidence_id").isNull(), "no evidence_id").when(F.col("e.control_id").isNull(), "no control_id"))
    read, counts = materialize(lines.withColumn("reason", reason), {
        "lines": F.count(F.lit(1)), "rejected": F.count("reason")})
    return LedgerRead(read.filter("reason IS NULL").select("e.*").drop("_bad"),
                      read.filter("reason IS NOT NULL").select("value", "reason"), counts)


def _metric_columns() -> dict:
    cost = F.col("line_item_unblended_cost")
    return {
        "rows_read": F.count(F.lit(1)),
        "null_cost": F.count_if(cost.isNull()),
        "zero_or_null_cost": F.count_if(cost.isNull() | (money(cost) == 0)),
        "null_id": F.count_if(F.col(ID).isNull()),
    }


def usage_run_metrics(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach run counters to a raw usage frame; they are filled when
    the frame is consumed by any action (no extra pass)."""
    obs = Observation("usage_run_metrics")
    out = raw.observe(obs, *[c.alias(n) for n, c in _metric_columns().items()])
    return out, obs


def usage_metrics_frame(raw: DataFrame) -> DataFrame:
    """A13 as a one-row frame (the same counters, as a standalone aggregate)."""
    return raw.agg(*[c.cast("bigint").alias(n) for n, c in _metric_columns().items()])
