"""Stored tables dealt by Spark's own bucketing: joins and groups on the bucket keys
read them without an exchange (D1, D6, Q2)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from costlake.operators.upsert import upsert
from costlake.session import scratch_path


@contextmanager
def bucketed(df: DataFrame, keys: list[str], buckets: int, path: str | None = None, dealt: bool = False) -> Iterator[DataFrame]:
    """``df`` stored in ``buckets`` by ``keys`` and sorted by them, as a frame for the block.

    The rows are dealt once, one file a bucket; ``dealt`` says that they are already
    partitioned so and go to their files without an exchange. The table's name is gone from the
    session's catalog when the block ends; its files stay under ``path``."""
    spark = df.sparkSession
    name = "costlake_bucketed_" + uuid.uuid4().hex[:16]
    (df if dealt else df.repartition(buckets, *keys)).write.bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", path or scratch_path(spark, "bucketed")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def upsert_bucketed(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str], buckets: int,
                    check_unique: bool = True, bucket_keys: list[str] | None = None) -> DataFrame:
    """``upsert`` into a target that is bucketed by ``keys``: only the source is dealt
    anew, to the target's buckets, and nothing of the target is shuffled. With
    ``bucket_keys``, the target has its buckets by these of ``keys``, and the source comes
    dealt by them too: nothing is shuffled, and a bucket's source rows are hashed, not sorted."""
    if bucket_keys is None:
        return upsert(target, source.repartition(buckets, *keys), keys, update_cols, check_unique)
    if not set(bucket_keys) <= set(keys):
        raise ValueError("bucket keys must be part of the key")
    return upsert(target, source, keys, update_cols, check_unique, hash_source=True)
