"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a ring of 2**``RING_BITS`` slots; a row
hashes to a slot and belongs to the next point clockwise. Each shard has a
capacity, so rows that overflow a full shard continue clockwise to the next
shard with room. With ``epsilon`` 0 the capacities are the two integers around
rows / shards and add up to the rows, so shard counts differ by one at most;
with ``epsilon`` > 0 a shard may hold (1 + epsilon) times the mean and fewer
rows move when a shard is added.

Loads are counts, so who overflows is decided on counts alone:

1. rows are ordered by (ring point, row hash, doc_id, content, input place) and
   numbered by a range partitioning (no window over a group, so a doc_id that
   holds a third of the rows is spread over many tasks);
2. rows per ring point (shards x vnodes numbers, whatever the input size) go
   to the driver, which fills the shards and returns intervals of ranks;
3. the intervals (at most a few per ring point) are joined back by broadcast.

Defined results: a NULL text has size 1 and the checksum of the empty text; a
NULL doc_id hashes like a constant and is placed like any row; repeated rows
take ranks of their own, so each gets its own slot; an empty table gives an
empty result; extra columns are carried along, clashing names replaced.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.text import packed, text_of
from costlake.operators.keys import assign_keys_range

RING_BITS = 16
OUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def ring(spark, shards: int, vnodes: int) -> DataFrame:
    """Ring points: (point slot, shard, order clockwise); slots taken twice go
    to the smaller shard. shards x vnodes rows."""
    pts = (spark.range(shards * vnodes)
           .select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
           .select("shard", _slot(F.xxhash64(F.lit("vnode"), "shard", "v")).alias("at"))
           .groupBy("at").agg(F.min("shard").alias("shard")))
    return pts


def _slot(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - RING_BITS).cast("int")


def _slot_owner(spark, shards: int, vnodes: int) -> tuple[DataFrame, list[int]]:
    """slot -> clockwise order of its ring point, for all 2**RING_BITS slots,
    and the shard of each point. The order starts after the last point, so
    the slots of a point are contiguous in ``turn``."""
    pts = sorted((r["at"], r["shard"]) for r in ring(spark, shards, vnodes).collect())
    turn0 = pts[-1][0] + 1
    size = 1 << RING_BITS
    rel = sorted(((at - turn0) % size, s) for at, s in pts)
    bounds = spark.createDataFrame(
        [(i, (rel[i - 1][0] + 1) if i else 0, at) for i, (at, _) in enumerate(rel)], "point int, lo int, hi int")
    slots = bounds.select("point", F.explode(F.sequence("lo", "hi")).alias("turn")).select(
        "point", ((F.col("turn") + turn0) % size).cast("int").alias("_at"))
    return slots, [s for _, s in rel]


def fill(counts: list[int], shard_of: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Bounded loads on counts: ``counts[i]`` rows belong to ring point i of
    shard ``shard_of[i]``. Every point first keeps what its shard has room
    for, in ring order; the rest travels clockwise. Returns intervals
    (point, first rank, end rank, shard, first slot)."""
    room, used, out, carry = list(capacity), [0] * len(capacity), [], deque()
    n = len(counts)

    def take(point: int, lo: int, hi: int, shard: int) -> int:
        k = min(hi - lo, room[shard])
        if k:
            out.append((point, lo, lo + k, shard, used[shard]))
            room[shard] -= k
            used[shard] += k
        return lo + k

    rest = []
    for i in range(n):
        lo = take(i, 0, counts[i], shard_of[i])
        rest.append((i, lo, counts[i]))
    for turn in range(2 * n):
        i = turn % n
        if turn < n and rest[i][1] < rest[i][2]:
            carry.append(rest[i])
        while carry and room[shard_of[i]]:
            p, lo, hi = carry.popleft()
            lo = take(p, lo, hi, shard_of[i])
            if lo < hi:
                carry.appendleft((p, lo, hi))
    if carry:
        raise ValueError("capacities are smaller than the rows")
    return out


def capacities(rows: int, shards: int, epsilon: float) -> list[int]:
    if epsilon <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int((1 + epsilon) * rows / shards) + 1] * shards


def bounded_ring(docs: DataFrame, shards: int = 16, vnodes: int = 64, epsilon: float = 0.0,
                 key: str = "doc_id", text: str = "text", drop_text: bool = True) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard."""
    spark = docs.sparkSession
    t = text_of(text)
    slots, shard_of = _slot_owner(spark, shards, vnodes)
    rows = docs.select(
        packed(docs, (*OUT, text) if drop_text else tuple(OUT)), F.col(key).alias("_key"),
        (F.octet_length(t) + 1).cast("bigint").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit("row"), F.col(key)).alias("_h"), F.monotonically_increasing_id().alias("_place"))
    # 2**RING_BITS rows of two ints: a fixed bound.
    rows = rows.withColumn("_at", _slot(F.col("_h"))).join(F.broadcast(slots), "_at")
    ranked = assign_keys_range(rows, ["point", "_h", "_key", "text_crc32", "size", "_place"], "_rank")
    got = {r["point"]: r["n"] for r in ranked.groupBy("point").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [got.get(i, 0) for i in range(len(shard_of))]
    plan = fill(counts, shard_of, capacities(sum(counts), shards, epsilon))
    first, at = [], 0
    for c in counts:
        first.append(at)
        at += c
    plan_df = spark.createDataFrame([(p, first[p] + lo, first[p] + hi, s, base) for p, lo, hi, s, base in plan],
                                    "_point int, _lo long, _hi long, shard int, _base long")
    r = F.col("_rank") - 1
    placed = ranked.join(F.broadcast(plan_df), (F.col("point") == F.col("_point"))
                         & (r >= F.col("_lo")) & (r < F.col("_hi")))
    return placed.select("_doc.*", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("_base") + r - F.col("_lo")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
