"""The table layer: the only place that writes.

A warehouse is a folder with one sub-folder per table. Each write creates a
version folder of its own, ``<table>/v=<n>-<attempt>``, and then one commit file
``<table>/_commits/<n>`` that names it; the highest commit is the table. So a
step may read the table it replaces (Spark cannot overwrite a path it is
reading), a write that fails at any point leaves the old version in place,
and a retry takes a fresh folder. Facts are partitioned by ``usage_date``; ``write_partitions``
rewrites only the dates present in the new rows (dynamic partition
overwrite) inside the current version, from staged rows that a reader after a crash
finds and puts in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return None if line is None else str(line).strip()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise OSError(f"already written: {path}")
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        raise OSError(f"could not write {path}")


class Warehouse:
    """Named, versioned Parquet tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _committed(self, name: str) -> int:
        """Number of the newest commit of ``name``, 0 if there is none."""
        fs, p = _fs(self.spark, f"{self.root}/{name}/_commits")
        if not fs.exists(p):
            return 0
        found = [st.getPath().getName() for st in fs.listStatus(p)]
        return max((int(f) for f in found if f.isdigit()), default=0)

    def location(self, name: str) -> str | None:
        n = self._committed(name)
        return f"{self.root}/{name}/{_read_text(self.spark, f'{self.root}/{name}/_commits/{n}')}" if n else None

    def exists(self, name: str) -> bool:
        return self.location(name) is not None

    def read(self, name: str) -> DataFrame | None:
        """Current version; read with the schema it was written with, so
        partition columns keep their type (no inference of dates)."""
        loc = self.location(name)
        if loc is None:
            return None
        self._finish_overwrites(name)
        schema = _read_text(self.spark, f"{loc}/_schema.json")
        reader = self.spark.read
        if schema:
            reader = reader.schema(StructType.fromJson(json.loads(schema)))
        return reader.parquet(loc)

    def replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None, dealt: bool = False) -> str:
        """Write ``df`` as a new version of ``name`` and switch to it. ``dealt`` says
        that its tasks already hold ranges of the partition values, so no row moves."""
        n = self._committed(name) + 1
        v = f"v={n}-{uuid.uuid4().hex[:12]}"
        if partition_by and not dealt:
            # AQE sizes the write partitions: a hot value is split, small ones merged.
            df = df.hint("rebalance", *partition_by)
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{name}/{v}")
        _write_text(self.spark, f"{self.root}/{name}/{v}/_schema.json", json.dumps(df.schema.jsonValue()))
        _write_text(self.spark, f"{self.root}/{name}/_commits/{n}", v)
        return f"{self.root}/{name}/{v}"

    def write_partitions(self, name: str, df: DataFrame, partition_col: str | list[str] = "usage_date",
                         dealt: bool = False) -> str:
        """Overwrite only the partitions whose values occur in ``df``.

        ``df`` must hold the *complete* rows of those partitions (see
        ``upsert_partitions``), or rows would be lost. Dynamic partition
        overwrite is set for this write only; it is one job with one commit.
        """
        cols = [partition_col] if isinstance(partition_col, str) else list(partition_col)
        loc = self.location(name)
        if loc is None:
            return self.replace(name, df, cols, dealt)
        self._finish_overwrites(name)
        # Spark cannot overwrite partitions it reads in the same plan: the rows are staged
        # first, and stay named until the overwrite is done, so a crash in it is mended.
        # They are staged by partition value, so the overwrite moves no row between tasks.
        attempt = uuid.uuid4().hex
        staged = df if dealt else df.hint("rebalance", *cols)
        staged.write.partitionBy(*cols).parquet(f"{self.root}/{name}/_staged/{attempt}")
        _write_text(self.spark, f"{self.root}/{name}/_pending/{attempt}",
                    json.dumps({"cols": cols, "into": loc, "schema": df.schema.jsonValue()}))
        self._finish_overwrites(name)
        return loc

    def _finish_overwrites(self, name: str) -> None:
        """Carry out the overwrites of ``name`` that are staged; one that was cut short is
        done again from its start, with the same result."""
        fs, p = _fs(self.spark, f"{self.root}/{name}/_pending")
        if not fs.exists(p):
            return
        for f in sorted(st.getPath().getName() for st in fs.listStatus(p) if not st.getPath().getName().endswith(".tmp")):
            told = json.loads(_read_text(self.spark, f"{self.root}/{name}/_pending/{f}"))
            staged = f"{self.root}/{name}/_staged/{f}"
            reader = self.spark.read
            if "schema" in told:
                reader = reader.schema(StructType.fromJson(told["schema"]))
            self._overwrite(reader.parquet(staged), told["cols"], told["into"])
            for done in (f"{self.root}/{name}/_pending/{f}", staged):
                fs.delete(_fs(self.spark, done)[1], True)

    @staticmethod
    def _overwrite(rows: DataFrame, cols: list[str], loc: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(loc)

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions of ``name``, and what failed attempts
        before them left; returns the number of folders. Nobody may still read those."""
        newest = self._committed(name)
        fs, p = _fs(self.spark, f"{self.root}/{name}")
        gone = 0
        for st in fs.listStatus(p) if newest else []:
            folder = st.getPath().getName()
            if folder.startswith("v=") and int(folder[2:].split("-")[0]) <= newest - keep:
                gone += bool(fs.delete(st.getPath(), True))
        for n in range(1, newest - keep + 1):
            fs.delete(_fs(self.spark, f"{self.root}/{name}/_commits/{n}")[1], False)
        return gone

    def drop(self, name: str) -> None:
        fs, p = _fs(self.spark, f"{self.root}/{name}")
        if fs.exists(p):
            fs.delete(p, True)


def materialize_table(spark: SparkSession, parquet_path: str, wh: Warehouse, name: str) -> str:
    """``CREATE OR REPLACE TABLE name AS SELECT * FROM parquet``."""
    return wh.replace(name, spark.read.parquet(parquet_path))


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None,
            args: dict | None = None) -> DataFrame:
    """Run SQL text over named frames with named parameters (``:name``).

    The frames are temporary views while the text is analysed and no longer: the
    session keeps its own views, also those of the same names. Parameters
    are bound by Spark (no string splicing).
    """
    tables = tables or {}
    held = {t.name: spark.table(t.name) for t in spark.catalog.listTables() if t.isTemporary and t.name in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text, args=args or None)
    finally:
        for name in tables:
            if name in held:
                held[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def read_parquet_sql(spark: SparkSession, path: str) -> DataFrame:
    """S8 file scan: ``SELECT * FROM parquet.`path` ``."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def partition_lookup(df: DataFrame, usage_date: str | None = None, start: str | None = None,
                     end: str | None = None) -> DataFrame:
    """Slice a fact by date; on a table partitioned by ``usage_date``
    the predicate becomes a partition filter (only those folders are read)."""
    c = F.col("usage_date")
    if usage_date is not None:
        df = df.filter(c == usage_date)
    if start is not None:
        df = df.filter(c >= start)
    if end is not None:
        df = df.filter(c < end)
    return df


MAX_PUSHED_KEYS = 1000      # looked-up values that go into the scan's own filter


def write_for_lookup(df: DataFrame, path: str, key: str, partition_by: list[str], distinct_keys: int,
                     row_group_bytes: int = 128 << 20, dealt: bool = False) -> None:
    """Write ``df`` so that a lookup by ``key`` reads few row groups: sorted by it inside
    each partition value (narrow minima and maxima), with a Parquet Bloom filter
    on it for row groups whose range holds a value that they lack. ``dealt`` says that the
    tasks already hold ranges of partition value and key: no row moves, and a
    file holds few keys."""
    ((df if dealt else df.hint("rebalance", *partition_by)).sortWithinPartitions(*partition_by, key).write
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct_keys))
     .option("parquet.block.size", str(row_group_bytes)).partitionBy(*partition_by).parquet(path))


def lookup(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``wanted`` (one column, same name). Few values
    (counted) become the scan's filter, where statistics and Bloom filters skip row
    groups; more are joined, and the planner's size check decides how."""
    few = wanted.select(key).filter(F.col(key).isNotNull()).distinct().limit(MAX_PUSHED_KEYS + 1).collect()
    if len(few) <= MAX_PUSHED_KEYS:
        return df.filter(F.col(key).isin([r[0] for r in few]))
    return df.join(wanted.select(key).distinct(), key, "left_semi")
