"""Surrogate keys (W4) and the scalar MAX(key).

Two ways to number rows ``start + 1, start + 2, ...`` in a given order:

* ``global``: ``row_number() OVER (ORDER BY ...)``. Spark plans it with a
  single-partition exchange, so it is only for inputs with a known small
  bound (e.g. distinct services).
* ``range``: range-partition on the order columns, sort inside partitions,
  materialise (so both passes see the same rows in the same partitions),
  count rows per partition, turn the counts into offsets (a frame with one
  row per partition, broadcast) and add the row's position inside its
  partition. No step holds more than one partition; the only shuffle is
  the range partitioning (plus a tiny one for the per-partition counts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index


def max_key(df: DataFrame | None, key: str) -> int:
    """``COALESCE(MAX(key), 0)`` as a Python int (one scalar to the driver)."""
    if df is None:
        return 0
    v = df.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0


def max_key_column(df: DataFrame | None, key: str) -> Column:
    """A12 as a scalar subquery: ``COALESCE((SELECT MAX(key) FROM df), 0)``.

    Stays inside the plan (no driver round trip); Spark runs the one-row
    aggregate before the stage that needs it.
    """
    if df is None:
        return F.lit(0).cast("bigint")
    return df.agg(F.coalesce(F.max(key).cast("bigint"), F.lit(0).cast("bigint"))).scalar()


def _start(start: int | Column) -> Column:
    return start if isinstance(start, Column) else F.lit(int(start)).cast("bigint")


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def assign_keys_global(df: DataFrame, order_by: list[str | Column], key: str,
                       start: int | Column = 0) -> DataFrame:
    w = Window.orderBy(*_order(order_by))
    return df.withColumn(key, (F.row_number().over(w) + _start(start)).cast("bigint"))


def assign_keys_range(df: DataFrame, order_by: list[str | Column], key: str, start: int | Column = 0,
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Partition id and row index are taken in the task that sorts the range
    # partition, then written: later passes do not depend on file order.
    ordered = (df.repartitionByRange(n, *_order(order_by)).sortWithinPartitions(*_order(order_by))
               .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(ordered).withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the broadcast is bounded by the partition count.
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
         ).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)
    return (tagged.join(F.broadcast(offsets), "_pid", "left")
            .withColumn(key, (F.coalesce(F.col("_off"), F.lit(0)) + local + _start(start) + F.lit(1)).cast("bigint"))
            .drop("_mid", "_pid", "_off"))


def assign_surrogate_keys(df: DataFrame, order_by: list[str | Column], key: str, start: int | Column = 0,
                          method: str = "range", num_partitions: int | None = None) -> DataFrame:
    """Add ``key`` = ``start`` + position in ``order_by`` order (1-based)."""
    if method == "global":
        return assign_keys_global(df, order_by, key, start)
    if method == "range":
        return assign_keys_range(df, order_by, key, start, num_partitions)
    raise ValueError(f"unknown key method {method!r}")
