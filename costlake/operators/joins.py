"""Join helpers: the broadcast row limit and the salted shuffle join used
beyond it. Callers broadcast a side only when a proven bound on its rows
(a materialised count, or a span of days) is within ``broadcast_limit``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_SALTS = 32
DEFAULT_TASK_ROWS = 1_000_000


def broadcast_limit(spark) -> int:
    return int(spark.conf.get("costlake.broadcast.maxRows", str(DEFAULT_BROADCAST_ROWS)))


def tasks_for(spark, rows: int) -> int:
    """How many partitions ``rows`` (a known count of what a fan-out will make) need so
    that no task makes many more than ``costlake.task.rows`` of them: a table that
    grows gets more tasks, not larger ones. At least the shuffle partitions."""
    per_task = int(spark.conf.get("costlake.task.rows", str(DEFAULT_TASK_ROWS)))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


@contextmanager
def dealt_joins(spark) -> Iterator[None]:
    """Plans run inside the block may join frames where both sides were dealt alike by
    some of the join's keys; by default Spark then deals both anew by all of them.
    For keys that spread well on their own (a customer)."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_for(spark, rows: int) -> Iterator[None]:
    """Plans run inside the block shuffle into as many parts as ``rows`` need (``tasks_for``);
    unlike a ``repartition``, adaptive execution may still merge or split them."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(tasks_for(spark, rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salt_of: Column,
                salts: int = DEFAULT_SALTS, how: str = "inner") -> DataFrame:
    """Equi join on ``on`` that spreads each key over ``salts`` tasks.

    ``big`` rows get salt ``pmod(salt_of, salts)`` (a column of ``big``
    with many distinct values, e.g. a customer key); each ``small`` row is
    copied once per salt. A key holding a third of ``big`` is then split
    over ``salts`` partitions instead of landing in one task.
    """
    b = big.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, on + ["_salt"], how).drop("_salt")
