"""Session helpers: a configured SparkSession and lineage cuts.

Lineage is cut by writing Parquet into the folder the session names in
``spark.checkpoint.dir`` (``materialize``). Only a local session may get a scratch
folder of its own when none is set; a cluster session must name a shared
folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(master: str | None = None, app: str = "costlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or get) a session with the settings the operators assume."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or 8
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="costlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, kind: str = "tables") -> str:
    """A fresh folder under the session's checkpoint folder (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/costlake-{kind}/{uuid.uuid4().hex}"


_SCOPE: ContextVar[list[str] | None] = ContextVar("costlake_scratch", default=None)


@contextmanager
def scratch_noted() -> Iterator[list[str]]:
    """The folders that ``materialize`` writes inside the block, as a list for
    whoever will ``delete_folders`` them once nothing reads them any more. Runs in
    other threads, and blocks around this one, keep theirs."""
    held: list[str] = []
    token = _SCOPE.set(held)
    try:
        yield held
    finally:
        _SCOPE.reset(token)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the folders that ``materialize`` writes inside the block and deletes
    them at its end, so nothing lazy that reads them may leave the block."""
    with scratch_noted() as held:
        try:
            yield
        finally:
            delete_folders(spark, held)


def materialize(df: DataFrame, metrics: dict[str, Column] | None = None) -> DataFrame | tuple[DataFrame, dict]:
    """Write ``df`` once as Parquet into the checkpoint folder and read it back.

    Cuts the lineage in one job (a reliable RDD checkpoint computes the plan
    twice unless cached), survives executor loss (the data is in the shared
    folder), and gives the planner exact file sizes for its broadcast
    decisions. With ``metrics`` (name -> aggregate column) the aggregates are
    collected by an ``Observation`` on the same write and returned with the
    frame.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    if (held := _SCOPE.get()) is not None:
        held.append(path)
    if metrics:
        obs = Observation(f"materialize-{uuid.uuid4().hex[:8]}")
        df.observe(obs, *[c.alias(n) for n, c in metrics.items()]).write.parquet(path)
        return spark.read.parquet(path), dict(obs.get)
    df.write.parquet(path)
    return spark.read.parquet(path)
