"""Insert-or-update by key without a table format that supports MERGE.

``upsert(target, source, keys, update_cols)``:
* key only in source -> source row inserted;
* key in both -> target row with ``update_cols`` taken from source;
* key only in target -> kept (an upsert never deletes).

It is a full outer join on the keys (one shuffle of both sides on the
keys). ``upsert_partitions`` restricts the work to the partitions the
source touches, so a daily re-run rewrites days, not the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(df: DataFrame, keys: list[str], what: str, check_cols: list[str] | None = None) -> DataFrame:
    """``df`` with a guarantee of one row per key: a repeated key fails the job.

    The rows per key are counted by a hash aggregate whose partial step runs
    before the shuffle, so even a key that holds a third of the rows never
    reaches one task whole; the repeated keys are then reduced to one scalar
    subquery (how many, and the smallest as an example). The rows themselves
    are neither sorted nor joined. The failure is attached to ``check_cols``
    (default: every non-key column), so column pruning cannot remove it.
    """
    others = [c for c in df.columns if c not in keys]
    key_text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bad = (counts.filter(F.col("_n") > 1)
           .agg(F.struct(F.count(F.lit(1)).alias("dups"), F.min(key_text).alias("example")).alias("b"))
           .scalar())
    fail = F.raise_error(F.concat(F.lit(f"duplicate key in {what}: "), bad.getField("example")))
    out = df
    for c in (check_cols or others or keys[:1]):
        out = out.withColumn(c, F.when(bad.getField("dups") > 0, fail).otherwise(F.col(c)))
    return out


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           check_unique: bool = True, hash_source: bool = False) -> DataFrame:
    """See the module doc. Source keys must be unique: with ``check_unique``
    a repeated key fails (as ``ON CONFLICT DO UPDATE`` refuses to update a
    row twice). Loaders whose source is an aggregate keyed by the same
    columns pass ``False``: their keys are unique by construction (and the
    grain check Q2 verifies the tables), so no sort-based guard runs over a
    whole fact. With ``hash_source`` a task hashes its part of the source instead of
    sorting both sides: for sources whose parts are bounded (``tasks_for``)."""
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    bad = [c for c in update_cols if c in keys or c not in cols]
    if bad:
        raise ValueError(f"update columns must be non-key target columns: {bad}")
    if check_unique:
        source = unique_rows(source.select(*cols), keys, "upsert source", update_cols or None)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_in_s"))
    if hash_source:
        s = s.hint("shuffle_hash")
    cond = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    out = []
    for c in cols:
        tc, sc = F.col(f"t_{c}"), F.col(f"s_{c}")
        if c in keys:
            v = F.when(in_t, tc).otherwise(sc)
        elif c in update_cols:
            v = F.when(in_s, sc).otherwise(tc)
        else:
            v = F.when(in_t, tc).otherwise(sc)
        out.append(v.alias(c))
    return j.select(*out)


def upsert_partitions(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
                      partition_col: str, check_unique: bool = True, touched: DataFrame | None = None,
                      hash_source: bool = False) -> DataFrame:
    """Upsert restricted to the ``partition_col`` values present in ``source``.

    Returns only the rows of the touched partitions; written with dynamic
    partition overwrite, the other partitions stay as they are. The set of
    touched values is a distinct over the source's partition column (dates:
    bounded by the calendar), joined as a semi join so the target scan can
    be pruned. ``touched`` gives these values where a caller knows them from a
    smaller frame; values beyond the source's keep their rows.
    """
    if partition_col not in keys:
        raise ValueError("partition column must be part of the key")
    touched = touched if touched is not None else source.select(partition_col).distinct()
    return upsert(target.join(touched, partition_col, "left_semi"), source, keys, update_cols, check_unique, hash_source)
