"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint has a bit where over half of the text's shingle hashes (XXH64)
have it. The 64 bits form a ring of four 16-bit segments. If two fingerprints
differ in at most three bits, some start on the ring has a chain of segments
whose cumulative differences stay within the proportional budgets
floor(length * 3 / 4): 0, 1, 2 and 3 bits. So

* the index key is a chain of two segments: the first exact, the second within
  one bit. A fingerprint emits, for each of the four starts, its own 32 bits
  and the variants that set one zero bit of the second segment (of two values
  one bit apart, one reaches the other that way): 36 rows on average, linear
  in the input, with buckets 2**16 times finer than one 16-bit segment;
* in a bucket, pairs must keep the budgets for chains of three and four
  segments (the last is the full Hamming check).

Only distinct fingerprints are indexed, so any number of equal texts is one
row. A bucket of many close fingerprints emits the edges of a spanning forest
instead of all its pairs: components lose nothing. A bucket holds distinct
fingerprints that share 32 bits.

Defined results: NULL or word-less texts have fingerprint zero and are linked
like any other; texts with fewer words than a shingle hash their whole word
sequence; repeated rows get the same values; a component whose doc_ids are all
NULL has a NULL component_id; an empty table gives an empty result; extra
columns pass through, clashing names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.components import components
from costlake.llm.text import ascii_lower, packed, space_words, text_of
from costlake.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEGMENTS, SEG_BITS = 4, 16
BUDGET = [length * MAX_BITS // SEGMENTS for length in range(SEGMENTS + 1)]
SMALL_BUCKET = 16


def majority(h: np.ndarray) -> int:
    """64-bit value with the bits set in over half of ``h`` (int64), as int64."""
    if not len(h):
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        part = h[at:at + 4096].astype(">i8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(bits * 2 > len(h)).tobytes(), "big", signed=True)


@F.arrow_udf(T.LongType())
def _majority_udf(hashes: pa.Array) -> pa.Array:
    values, at = hashes.values.to_numpy(zero_copy_only=False), hashes.offsets.to_numpy()
    return pa.array([majority(values[at[i]:at[i + 1]]) for i in range(len(hashes))], pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text", n: int = SHINGLE, drop_text: bool = False) -> DataFrame:
    """(_doc, fp): the packed columns and the fingerprint as a signed long."""
    d = docs.select(packed(docs, ("fingerprint", "component_id", text) if drop_text
                           else ("fingerprint", "component_id")), text_of(text).alias("text"))
    words = d.select("_doc", space_words(ascii_lower(F.col("text"))).alias("w"))
    size = F.size("w")
    each = F.transform(F.sequence(F.lit(1), size - (n - 1)),
                       lambda i: F.xxhash64(F.array_join(F.slice(F.col("w"), i, F.lit(n)), " ")))
    h = F.when(size >= n, each).when(size > 0, F.array(F.xxhash64(F.array_join("w", " ")))) \
         .otherwise(F.array().cast("array<bigint>"))
    return words.select("_doc", _majority_udf(h).alias("fp"))


def chain_keys(fps: DataFrame) -> DataFrame:
    """(k, fp): start << 32 | the first two segments from that start."""
    fp = F.col("fp")
    by_start = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("i"),
                 (fp if i == 0 else F.shiftleft(fp, SEG_BITS * i).bitwiseOR(
                     F.shiftrightunsigned(fp, 64 - SEG_BITS * i))).alias("r"))
        for i in range(SEGMENTS)])).alias("s"))
    hi = by_start.select("fp", (F.col("s.i") * (1 << 32)).alias("i"), F.shiftrightunsigned("s.r", 32).alias("hi"),
                         F.explode(F.array(F.lit(0).cast("bigint"),
                                           *[F.lit(1 << j).cast("bigint") for j in range(SEG_BITS)])).alias("bit"))
    return hi.filter(F.col("hi").bitwiseAND(F.col("bit")) == 0).select(
        (F.col("i") + F.col("hi").bitwiseOR(F.col("bit"))).alias("k"), "fp")


def _linked(k: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which differences ``x`` keep the chain budgets from start k >> 32."""
    turn = ((k >> 32) * SEG_BITS).astype(np.uint64)
    x = x.view(np.uint64)
    r = (x << turn) | np.where(turn > 0, x >> ((np.uint64(64) - turn) % np.uint64(64)), np.uint64(0))
    ok = np.ones(len(x), bool)
    for length in range(2, SEGMENTS + 1):
        ok &= np.bitwise_count(r >> np.uint64(64 - SEG_BITS * length)) <= BUDGET[length]
    return ok


def _forest(k: int, f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of one bucket: each row is compared with the
    rows that nobody has reached yet."""
    left, todo = f, []
    while len(left) or todo:
        if not todo:
            todo, left = [left[0]], left[1:]
        a = todo.pop()
        near = _linked(np.full(len(left), k), left ^ a)
        if near.any():
            yield np.full(int(near.sum()), a), left[near]
            todo.extend(left[near])
            left = left[~near]


def bucket_edges(k: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified edges of rows sorted by key ``k``: all pairs of small buckets,
    a spanning forest of each larger one."""
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[first, len(k)])
    small = np.repeat(size <= SMALL_BUCKET, size)
    a, b = [], []
    for d in range(1, min(SMALL_BUCKET, int(size.max(initial=1)))):
        at = np.flatnonzero((k[d:] == k[:-d]) & small[d:])
        at = at[_linked(k[at], f[at] ^ f[at + d])]
        a.append(f[at])
        b.append(f[at + d])
    for g in np.flatnonzero(size > SMALL_BUCKET):
        for x, y in _forest(int(k[first[g]]), f[first[g]:first[g] + size[g]]):
            a.append(x)
            b.append(y)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads a partition sorted by key; the rows of the last key wait for the
    next batch, as their bucket may go on there."""
    k = f = np.zeros(0, np.int64)

    def out(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(k) > 1:
            a, b = bucket_edges(k, f)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.r_[k, batch.column(0).to_numpy(zero_copy_only=False)]
        f = np.r_[f, batch.column(1).to_numpy(zero_copy_only=False)]
        last = int(np.searchsorted(k, k[-1]))
        yield from out(k[:last], f[:last])
        k, f = k[last:], f[last:]
    yield from out(k, f)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): fingerprints of ``fps`` (distinct ``fp``) at most three bits apart,
    enough of them to connect every component."""
    keys = chain_keys(fps).repartition("k").sortWithinPartitions("k")
    return keys.mapInArrow(_edges, "a bigint, b bigint")


def _grouped(docs: DataFrame, key: str, text: str, n: int, drop_text: bool) -> DataFrame:
    """(_doc, id, fp, label, component_id); label is the component's smallest fp."""
    rows = materialize(with_fingerprint(docs, text, n, drop_text).select("_doc", F.col(f"_doc.{key}").alias("id"), "fp"))
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("rep")))
    labels = components(materialize(fingerprint_links(fps.select("fp"))))
    of = materialize(fps.join(labels, fps["fp"] == labels["node"], "left")
                     .select("fp", "rep", F.coalesce("label", "fp").alias("label")))
    ids = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    # A table of its own, so that AQE can split a fingerprint with many rows.
    table = materialize(of.join(ids, "label").select("fp", "label", "component_id"))
    return rows.join(table, "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE,
                    drop_text: bool = False) -> DataFrame:
    """``docs`` with ``fingerprint`` (16 hex digits) and ``component_id``."""
    return _grouped(docs, key, text, n, drop_text).select(
        "_doc.*", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest doc_id (NULL last),
    then of the smallest content digest. Rows with equal id and text count as one
    row and collapse on the map side; whole texts are shuffled once. Rows are told
    apart by the SHA-256 of id and text, so no two different ones meet."""
    content = F.unhex(F.sha2(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), text_of(text)).cast("binary"), 256))
    narrow = docs.select(F.col(key).alias("id"), content.alias("row"), F.col(text).alias("text"))
    found = _grouped(narrow, "id", "text", n, True)
    kept = materialize(found.groupBy("label")
                       .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("_doc.row")))
                            .alias("m")).select(F.col("m.row").alias("_row")))
    d = docs.select(packed(docs), content.alias("_row")).dropDuplicates(["_row"])
    return d.join(kept, "_row", "left_semi").select("_doc.*")
