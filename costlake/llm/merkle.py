"""Merkle manifest of a dataset, with leaf coordinates from bitmap ranks.

1. ``build_index``: the ids of every group become a compressed bitmap. Words of 64
   ids are merged by ``bit_or`` (partial merges before the shuffle), words
   without ids are not kept, and a popcount directory says how many rows of the
   group lie before each word: within its bucket of 512 words and,
   by a running sum over buckets, before the bucket.
2. ``leaf_slots``: a leaf's place in its group is a rank query on its id: the
   directory's count, and the popcount of the lower bits of the word. Leaves
   are never sorted. Ids that occur more than once (a NULL id counts as the least
   one) are numbered by their leaves in a pass of their own.
3. ``levels``: sixteen consecutive slots make one keyed array and become its
   digest, level by level, until one node of each group is left; the groups' last
   nodes, in the order of their names, go the same way to the root.
4. ``proofs``: from the root down, every child gets what stands before and after
   it in its array; a leaf's proof is that list from its own array up.

Scale: rows of a level are keyed by (group, slot / 16), so a group with a third
of all documents is spread evenly; texts are read once and never shuffled; a level
is a sixteenth of the one below. Nothing but the height of the tree (the largest
group's row count, the number of groups) comes to the driver.

Defined results: a NULL field hashes as ``-``; a NULL id comes first in its group and
is never tampered with; rows of one id are ordered by leaf, and equal rows take
any of their places; a NULL group is a group of its own, before the others; very
long texts are hashed whole; an empty table gives no rows. Only the hashed
fields are read, so extra columns of the table cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.operators.keys import assign_keys_range
from costlake.session import materialize

FAN = 16
BUCKET_BITS = 9                    # 512 words of 64 ids
MAX_BROADCAST_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEAST = -(1 << 63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def H(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts in UTF-8, lower-case hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
           text: str = "text", tampered: Column | None = None) -> DataFrame:
    """(id, key, grp, leaf, forged): ``forged`` is the leaf of the row with its
    text's A-Z in lower case where ``tampered`` holds, NULL elsewhere."""
    cols = {c: F.col(c) for c in fields}
    low = {**cols, text: F.translate(F.col(text), UPPER, LOWER)}
    forged = F.when(tampered, H(*[field(c) for c in low.values()])) if tampered is not None else F.lit(None).cast("string")
    return docs.select(F.col(key).alias("id"), *_place(key, group),
                       H(*[field(c) for c in cols.values()]).alias("leaf"), forged.alias("forged"))


def _place(key: str, group: str) -> list[Column]:
    """The id without NULLs, and the group's name: NULL sorts before all names."""
    return [F.coalesce(F.col(key).cast("bigint"), F.lit(LEAST)).alias("key"),
            F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")).alias("grp")]


def _word(key: Column) -> Column:
    return F.shiftright(key, 6)


def _bits_from(key: Column, ones: int) -> Column:
    """``ones`` shifted left to the id's place in its word."""
    return F.call_function("shiftleft", F.lit(ones).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))


def build_index(docs: DataFrame, key: str = "doc_id", group: str = "source") -> tuple[DataFrame, dict]:
    """(grp, word, bits, before, n): one row per word that holds ids, with the rows
    of the group before it and in the whole group; and its number of words and of
    rows beyond the distinct ids. Stored."""
    at = docs.select(*_place(key, group))
    words = (at.groupBy("grp", _word(F.col("key")).alias("word"))
             .agg(F.bit_or(_bits_from(F.col("key"), 1)).alias("bits"),
                  F.count(F.lit(1)).alias("rows")))
    words = materialize(words.withColumn("bucket", F.shiftright("word", BUCKET_BITS)))
    inside = Window.partitionBy("grp", "bucket").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and 32,768 ids: the directory.
    buckets = words.groupBy("grp", "bucket").agg(F.sum("rows").alias("held"))
    run = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("grp")
    directory = buckets.select(F.col("grp").alias("g"), F.col("bucket").alias("b"),
                               F.coalesce(F.sum("held").over(run), F.lit(0)).alias("low"), F.sum("held").over(whole).alias("n"))
    local = words.withColumn("here", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    index = local.join(directory, (F.col("grp") == F.col("g")) & (F.col("bucket") == F.col("b"))).select(
        "grp", "word", "bits", "rows", (F.col("low") + F.col("here")).alias("before"), "n")
    return materialize(index, {"words": F.count(F.lit(1)),
                               "spare": F.coalesce(F.sum(F.col("rows") - F.bit_count("bits")), F.lit(0)),
                               "largest": F.coalesce(F.max("n"), F.lit(0))})


def _numbered(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Slots of the rows in words that hold an id more than once: the rows before
    the word and the place among the word's rows in order of id and leaf. Stored
    row numbers split equal rows, so no task gets all copies of one."""
    rows = materialize(rows.withColumn("copy", F.monotonically_increasing_id()))
    placed = materialize(assign_keys_range(rows, ["grp", "word", "key", "leaf", "copy"], "place"))
    first = placed.groupBy("grp", "word").agg(F.min("place").alias("first"))
    base = index.join(first, ["grp", "word"]).select("grp", "word", (F.col("before") - F.col("first")).alias("base"), "n")
    # One row per such word: a broadcast where Spark's size check allows, else AQE splits a hot word.
    return placed.join(base, ["grp", "word"]).select("id", "grp", "leaf", "forged", (F.col("base") + F.col("place")).alias("slot"), "n")


def leaf_slots(found: DataFrame, index: DataFrame, facts: dict) -> DataFrame:
    """(id, grp, leaf, forged, slot, n): every leaf with its place in its group."""
    small = F.broadcast(index) if facts["words"] <= MAX_BROADCAST_ROWS else index
    j = found.withColumn("word", _word(F.col("key"))).join(small, ["grp", "word"])
    below = F.bitwise_not(_bits_from(F.col("key"), -1))
    rank = (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("slot")
    if not facts["spare"]:
        return j.select("id", "grp", "leaf", "forged", rank, "n")
    plain = F.col("rows") == F.bit_count("bits")
    j = materialize(j)
    again = j.filter(~plain).select("id", "grp", "word", "key", "leaf", "forged")
    return j.filter(plain).select("id", "grp", "leaf", "forged", rank, "n").unionByName(_numbered(again, index))


def _join_text(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _reduce(nodes: DataFrame, *more: str) -> DataFrame:
    """(grp, slot, n, kids, node): sixteen slots to one keyed array and its digest;
    ``n`` is the number of nodes on the new level."""
    kids = F.array_sort(F.collect_list(F.struct("slot", "node", *more)))
    up = (nodes.groupBy("grp", F.floor(F.col("slot") / FAN).cast("bigint").alias("up"))
          .agg(kids.alias("kids"), F.ceil(F.max("n") / F.lit(FAN)).cast("bigint").alias("n")))
    return up.select("grp", F.col("up").alias("slot"), "n", "kids",
                     H(_join_text(F.transform("kids", lambda k: k.node))).alias("node"))


def height(n: int) -> int:
    """Levels above the leaves of ``n`` nodes."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def levels(nodes: DataFrame, n: int, *more: str) -> list[DataFrame]:
    """The keyed arrays of each level over ``nodes`` (grp, slot, n, node, ...); ``n``
    is the largest group's number of nodes. The first level has all groups (one
    of a single node keeps it, see ``top_nodes``), a higher one those that go on.
    Stored."""
    out = [materialize(_reduce(nodes, *more))]
    for _ in range(1, height(n)):
        out.append(materialize(_reduce(out[-1].filter("n > 1").select("grp", "slot", "n", "node"))))
    return out


def top_nodes(arrays: list[DataFrame]) -> DataFrame:
    """(grp, node): what remains of each group; a lone leaf remains itself."""
    lone = F.when(F.size("kids") == 1, F.element_at("kids", 1).node).otherwise(F.col("node"))
    out = arrays[0].filter("n = 1").select("grp", lone.alias("node"))
    for a in arrays[1:]:
        out = out.unionByName(a.filter("n = 1").select("grp", "node"))
    return out


def _step(kids: Column, i: Column) -> Column:
    """What stands before and after child ``i`` (from 0) of an array."""
    names = F.transform(kids, lambda k: k.node)
    return F.struct(_join_text(F.slice(names, F.lit(1), i)).alias("pre"),
                    _join_text(F.slice(names, i + 2, F.greatest(F.size(kids) - i - 1, F.lit(0)))).alias("post"))


def _children(arrays: DataFrame, above: DataFrame, carry: list[str]) -> DataFrame:
    """Every child of ``arrays`` with its path: its own step, then its parent's."""
    each = arrays.join(above, ["grp", "slot"]).select("grp", "kids", "path", *carry, F.posexplode("kids").alias("i", "kid"))
    return each.select("grp", F.col("kid"), F.concat(F.array(_step(F.col("kids"), F.col("i"))), "path").alias("path"), *carry)


def paths_down(arrays: list[DataFrame], top: DataFrame, carry: list[str]) -> DataFrame:
    """(grp, slot, path, ...) of the nodes of the first of ``arrays``; ``top`` has
    the paths of each group's last node."""
    above = None
    for k in range(len(arrays) - 1, -1, -1):
        here = arrays[k].filter("n = 1").select("grp", "slot").join(top, "grp")
        if above is not None:
            kids = _children(arrays[k + 1], above, carry).select("grp", F.col("kid.slot").alias("slot"), "path", *carry)
            here = here.unionByName(kids)
        above = here
    return above


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, node, lambda acc, p: H(p.pre, acc, p.post))


def _lone_path() -> Column:
    return F.array().cast("array<struct<pre:string,post:string>>")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
             text: str = "text", tampered: Column | None = None) -> DataFrame:
    """One row per document: its id (named ``key``), ``leaf``, ``subroot``, ``root``,
    ``proof`` (array of the texts before and after it, from its own array up),
    ``proof_sha256``, ``folded_root`` (from the tampered leaf where there is one)
    and ``verified``."""
    index, facts = build_index(docs, key, group)
    found = leaf_slots(leaves(docs, fields, key, group, text, tampered), index, facts)
    arrays = levels(found.withColumnRenamed("leaf", "node"), facts["largest"], "id", "forged")

    subroots = materialize(top_nodes(arrays), {"groups": F.count(F.lit(1))})
    tops, n = subroots[0], subroots[1]["groups"]
    ranked = assign_keys_range(tops, ["grp"], "place", -1)
    nodes = ranked.select(F.lit("").alias("grp"), F.col("place").alias("slot"), F.lit(n).cast("bigint").alias("n"),
                          "node", F.col("grp").alias("name"))
    over = levels(nodes, n, "name")
    root = top_nodes(over).select("grp", _lone_path().alias("path"), F.col("node").alias("root"))
    parents = paths_down(over, root, ["root"])
    if n > 1:
        groups = _children(over[0], parents, ["root"])
    else:
        groups = parents.join(over[0], ["grp", "slot"]).select(F.explode("kids").alias("kid"), "path", "root")
    top = materialize(groups.select(F.col("kid.name").alias("grp"), F.col("kid.node").alias("subroot"), "path", "root"))

    carry = ["subroot", "root"]
    parents = paths_down(arrays, top, carry)
    docs_of = _children(arrays[0].filter("n > 1 OR size(kids) > 1"), parents, carry)
    lone = (arrays[0].filter("n = 1 AND size(kids) = 1").join(parents, ["grp", "slot"])
            .select("grp", F.element_at("kids", 1).alias("kid"), "path", *carry))
    rows = docs_of.unionByName(lone).select(F.col("kid.id").alias(key), F.col("kid.node").alias("leaf"), "subroot", "root",
                                            F.col("path").alias("proof"), F.col("kid.forged").alias("forged"))
    siblings = F.array_join(F.transform("proof", lambda p: F.concat(p.pre, p.post)), "")
    folded = fold(F.coalesce("forged", "leaf"), F.col("proof"))
    return rows.select(key, "leaf", "subroot", "root", "proof", H(siblings).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(key: str = "doc_id") -> Column:
    """Where 5 divides the CRC-32 of the decimal id; a NULL id is left alone."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
