"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: bigint); the label is the
    smallest node of the component.

    Every round is written to the checkpoint folder with its row count and a
    checksum; the rounds end when both stay. Minima are aggregated before they
    are joined back from a table of their own, so AQE can split a hub node.
    """
    def least(df: DataFrame) -> DataFrame:
        return materialize(df.groupBy("u").agg(F.min("v").alias("m")))

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        out, got = materialize(df, {"n": F.count(F.lit(1)),
                                    "s": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))})
        return out, (got["n"], got["s"])

    # Each edge once, from the larger node u to the smaller node v.
    now, state = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .distinct())
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large, _ = written(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .distinct())
        low = least(large)
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now, after = written(small)
        if after == state:
            break
        state = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
