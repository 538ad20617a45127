"""Benchmark decontamination with a distributed positional inverted index.

1. ``test_windows`` cuts the test items into windows of 13 consecutive words
   (an item of fewer words is one window), each distinct text once, and notes in which
   passages (``SPAN`` window starts and their words) they stand.
2. ``term_frequencies`` counts the test set's terms over the whole corpus, and
   ``rare_terms`` picks from them the rarest terms of every window: two more than a near
   match may lack, so that two are left.
3. ``build_index`` stores the postings (term, doc, pos) of those terms only, a small share
   of the corpus's tokens.
4. ``candidates`` intersects the offset-adjusted lists: the postings are dealt by
   document once, and inside that partition, without a further shuffle, shifted by
   their offsets in the passages and merged in ranges of ``BLOCK`` starts, one bit per
   place; where two bits of a window meet, it is a candidate. Windows that overlap share
   their rare terms, so a passage costs a sixth of what its windows would.
5. ``matches`` compares each candidate with the words of its document: every word at
   its place is an exact match; most words within ``slop`` words of their places is a
   near match. ``decontaminate`` joins the item ids last and adds up per document.

Scale: rows that leave a task are the postings of rare terms, the texts of documents that
have candidates' keys (one shuffle join), and per-match rows. A hot term's postings are
never grouped by term; joins with the windows broadcast them up to
``MAX_BROADCAST_ROWS`` rows (counted), beyond that both sides are shuffled with the
term salted. A passage that a third of the documents share costs rows in
proportion to its occurrences; the same passage in many items is matched once.

Defined results: NULL or word-less texts have no words and are never hit;
items without words have no windows; repeated item rows count once per item
id (a NULL id is named by the empty string); documents are told apart by
doc_id and text together, so repeated rows each get the same row; very long texts are
indexed whole; empty tables give no hits or no rows; extra columns pass through,
clashing names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.text import NON_WORD_RE, ascii_lower, packed, text_of
from costlake.operators.joins import salted_join
from costlake.session import materialize

WINDOW = 13
SLOP = 2
NEAR_SHARE = 0.8           # a near match has this share of the window's words near their places
SPAN = 48                  # window starts of a passage
BLOCK = 16                 # starts that are looked at together, a range of places in a document
MAX_BROADCAST_ROWS = 200_000
OUT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")


def words_of(c: str | Column) -> Column:
    """The words of a text; an empty piece is only at its ends."""
    return F.array_remove(F.split(ascii_lower(text_of(c)), NON_WORD_RE, -1), "")


def _doc_key(key: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.xxhash64(F.col(key), text_of(text)).alias("doc")]


def _bounded(df: DataFrame) -> tuple[DataFrame, bool]:
    df, m = materialize(df, {"n": F.count(F.lit(1))})
    return df, m["n"] <= MAX_BROADCAST_ROWS


def _join_small(rows: DataFrame, small: DataFrame, few: bool, on: str, salt: str) -> DataFrame:
    """``rows`` joined with a frame that has many fewer: broadcast, or else salted."""
    return rows.join(F.broadcast(small), on) if few else salted_join(rows, small, [on], F.col(salt))


def test_items(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    return items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"),
                        words_of(text).alias("words"))


def test_windows(test: DataFrame, n: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(wid, win) the distinct windows, numbered; (pid, wid, at) where they stand in the
    distinct passages; (item, wid) the items that have them. Stored."""
    if SPAN + n > 62:
        raise ValueError(f"windows of {n} words: {62 - SPAN} at most, one bit per place of a passage")
    size = F.size("words")
    starts = F.when(size >= n, F.sequence(F.lit(0), size - n)).when(size > 0, F.array(F.lit(0)))
    part = F.col("start") - F.col("start") % SPAN
    each = materialize(test.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start") + 1, F.lit(n)).alias("win"),
        F.slice("words", part + 1, F.lit(SPAN + n - 1)).alias("passage"), (F.col("start") % SPAN).alias("at")).distinct())
    windows = materialize(each.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()))
    passages = materialize(each.select("passage").distinct().withColumn("pid", F.monotonically_increasing_id()))
    both = materialize(each.join(windows, "win").join(passages, "passage").select("item", "pid", "wid", "at"))
    return windows, both.select("pid", "wid", "at").distinct(), both.select("item", "wid").distinct()


def lacking(n: Column) -> Column:
    """How many of ``n`` words a near match may lack."""
    return (n - F.ceil(F.lit(NEAR_SHARE) * n)).cast("int")


def term_frequencies(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """(word, freq) of the windows' words over all documents; words that the corpus
    lacks have no row. Stored."""
    asked, few = _bounded(windows.select(F.explode("win").alias("word")).distinct())
    tokens = docs.select(F.explode(words_of(text)).alias("word"))
    known = tokens.join(F.broadcast(asked), "word") if few else tokens.join(asked, "word")
    return materialize(known.groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def rare_terms(windows: DataFrame, freq: DataFrame) -> DataFrame:
    """(word, wid, off, least): the rarest distinct terms of each window with their
    offsets. A near match has ``least`` of them: two, or one where a window
    has too few distinct words for that."""
    n, distinct = F.size("win"), F.size(F.array_distinct("win"))
    miss = lacking(n)
    listed = F.least(distinct, miss + 2)
    terms = windows.select("wid", miss.alias("miss"), listed.alias("listed"), F.posexplode("win").alias("off", "word"))
    each = terms.groupBy("wid", "miss", "listed", "word").agg(F.collect_list("off").alias("offs")).join(freq, "word", "left")
    per = Window.partitionBy("wid")
    rank = F.row_number().over(per.orderBy(F.coalesce("freq", F.lit(0)), "word"))
    # More words that the corpus lacks than a near match may: it occurs nowhere.
    lost = F.sum(F.when(F.col("freq").isNull(), F.size("offs")).otherwise(0)).over(per)
    two = F.col("listed") - F.col("miss") >= 2
    return (each.withColumn("r", rank).withColumn("lost", lost)
            .filter((F.col("lost") <= F.col("miss")) & F.col("freq").isNotNull() & (~two | (F.col("r") <= F.col("listed"))))
            .select("word", "wid", F.explode("offs").alias("off"), F.when(two, 2).otherwise(1).alias("least")))


ALONE = 1 << 62            # of a place where one term is enough for some window


def place_terms(rare: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word, term, pid, q, bits): the rare terms at their places in the passages;
    (pid, wid, at, least, mask): the windows of the passages, with their terms' places.
    Stored."""
    at = rare.join(places, "wid").withColumn("q", (F.col("at") + F.col("off")).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("q"))
    terms = at.groupBy("word", "pid", "q").agg(F.min("least").alias("least")).select(
        "word", F.xxhash64("word").alias("term"), "pid", "q", (bit + F.when(F.col("least") == 1, ALONE).otherwise(0)).alias("bits"))
    masks = at.groupBy("pid", "wid", "at").agg(F.min("least").alias("least"), F.bit_or(bit).alias("mask"))
    return materialize(terms), materialize(masks)


def build_index(docs: DataFrame, terms: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token postings (term, doc, pos) of ``docs`` as a stored table, of the given words
    (a frame with ``word``) or of all. A term is its word's hash; rows that repeat
    give one posting."""
    postings = docs.select(*_doc_key(key, text)[1:], F.posexplode(words_of(text)).alias("pos", "word"))
    if terms is not None:
        asked, few = _bounded(terms.select("word").distinct())
        postings = _join_small(postings, asked, few, "word", "doc")
    return materialize(postings.select(F.xxhash64("word").alias("term"), "doc", "pos").distinct())


def candidates(postings: DataFrame, terms: DataFrame, masks: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc, wid, first): windows and, for each, the start of a range that enough of its
    rare terms reach.

    Terms of one near match have starts at most 2 * ``slop`` apart, so a start in
    the last places of a range counts for the next range too."""
    terms, few = _bounded(terms.select("term", "pid", "q", "bits"))
    spread = postings.repartition("doc")      # the groups below keep this partitioning
    at = _join_small(spread, terms, few, "term", "doc").withColumn("start", F.col("pos") - F.col("q"))
    block = F.floor(F.col("start") / BLOCK).cast("int")
    late = F.pmod("start", F.lit(BLOCK)) >= BLOCK - 2 * slop
    dealt = at.select("doc", "pid", "bits", F.explode(
        F.when(late, F.array(block, block + 1)).otherwise(F.array(block))).alias("block"))
    groups = (dealt.groupBy("doc", "pid", "block").agg(F.bit_or("bits").alias("bits"))
              .filter(F.bit_count("bits") >= 2))
    masks, few = _bounded(masks)
    j = _join_small(groups, masks, few, "pid", "doc").filter(F.bit_count(F.col("bits").bitwiseAND(F.col("mask"))) >= F.col("least"))
    return j.select("doc", "wid", (F.col("block") * BLOCK + F.col("at")).cast("int").alias("first"))


def matches(docs: DataFrame, found: DataFrame, windows: DataFrame, slop: int = SLOP,
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, doc, wid, size, exact, near): the starts of a window's exact matches in a
    document, and whether it also has a near match away from them.

    Each candidate is compared with the few words around it: first as sets of words, then
    start by start, and the starts that are left place by place."""
    reach = 2 * slop + slop           # a near match's start may lie so far before the range
    per_doc = found.groupBy("doc").agg(F.collect_list(F.struct("wid", "first")).alias("at"))
    d = docs.select(*_doc_key(key, text), text_of(text).alias("text")).join(per_doc, "doc")
    each = d.select("id", "doc", words_of("text").alias("words"), "at").select("id", "doc", "words", F.explode("at").alias("c"))
    windows, few = _bounded(windows.select("wid", "win", F.size("win").alias("size"), (
        F.size(F.array_distinct("win")) - lacking(F.size("win"))).alias("needed")))
    longest = WINDOW if windows.isEmpty() else windows.agg(F.max("size")).first()[0]
    first = F.col("c.first") - reach                              # first start that is looked at
    low = F.greatest(first - slop, F.lit(0))
    around = F.slice("words", low + 1, F.greatest(first + BLOCK + 2 * reach + longest + slop - low, F.lit(0)))
    here = each.select("id", "doc", "c.wid", first.alias("first"), low.alias("low"), around.alias("around"))
    j = _join_small(here, windows, few, "wid", "doc").filter(F.size(F.array_intersect("around", "win")) >= F.col("needed"))

    def part(start: Column, end: Column) -> Column:
        """The words of the document from ``start`` to before ``end``."""
        at = F.greatest(start - F.col("low"), F.lit(0))
        return F.slice("around", at + 1, F.greatest(end - F.col("low") - at, F.lit(0)))

    def alike(s: Column) -> Column:
        near_by = part(s - slop, s + F.col("size") + slop)
        return F.size(F.array_intersect(near_by, F.col("win"))) >= F.col("needed")

    starts = F.sequence(F.col("first"), F.col("first") + (BLOCK + 2 * reach - 1))
    rows = j.select("id", "doc", "wid", "size", "win", "around", "low", F.explode(F.filter(starts, alike)).alias("s"))
    s = F.col("s")
    placed = F.filter(F.transform("win", lambda w, i: F.array_contains(part(s + i - slop, s + i + slop + 1), w)), lambda x: x)
    near = rows.filter(F.size(placed) >= F.col("size") - lacking(F.col("size"))).select(
        "id", "doc", "wid", "size", "s", ((s >= 0) & (part(s, s + F.col("size")) == F.col("win"))).alias("same"))
    # A window has few starts in one document (bounded by its length), so they meet in one
    # row; those of repeated rows are the same.
    both = near.groupBy("id", "doc", "wid", "size").agg(
        F.collect_set("s").alias("near"), F.collect_set(F.when(F.col("same"), F.col("s"))).alias("exact"))
    apart = F.exists("near", lambda a: ~F.exists("exact", lambda e: F.abs(e - a) <= slop))
    return both.select("id", "doc", "wid", "size", "exact", apart.alias("near"))


def decontaminate(docs: DataFrame, items: DataFrame, n: int = WINDOW, slop: int = SLOP, min_share_pct: int = 5,
                  key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  drop_text: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256, contaminated and
    n_near (distinct windows with a near match that is no exact one of the same window
    within ``slop`` words)."""
    windows, places, named = test_windows(test_items(items, item_key, item_text), n)
    terms, masks = place_terms(rare_terms(windows, term_frequencies(docs, windows, text)), places)
    found = candidates(build_index(docs, terms, key, text), terms, masks, slop)
    got = materialize(matches(docs, found, windows, slop, key, text))

    # At most one window of each length starts at a place, so a document's list is bounded by it.
    spans = F.array_sort(F.flatten(F.collect_list(F.transform(
        "exact", lambda s: F.struct(s.alias("s"), (s + F.col("size")).alias("e"))))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct(
        F.greatest(a.end, x.e).alias("end"),
        (a.n + F.greatest(F.lit(0), x.e - F.greatest(a.end, x.s))).alias("n")), lambda a: a.n)
    hits = got.groupBy("id", "doc").agg(spans.alias("spans"), F.count_if("near").alias("n_near"))
    of = (got.filter(F.size("exact") > 0).select("id", "doc", "wid").join(named, "wid")
          .groupBy("id", "doc").agg(F.array_sort(F.collect_set("item")).alias("items")))
    sums, few = _bounded(hits.join(of, ["id", "doc"], "left").select(
        "id", "doc", covered.cast("bigint").alias("n_hit"), "n_near", "items"))
    d = docs.select(packed(docs, (*OUT, text) if drop_text else OUT), *_doc_key(key, text),
                    F.size(words_of(text)).cast("bigint").alias("n_words"))
    j = d.join(F.broadcast(sums) if few else sums, ["id", "doc"], "left")

    def count(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("bigint")

    ids = F.coalesce(F.array_join("items", ","), F.lit(""))
    out = j.select("_doc.*", "n_words", count(F.col("n_hit")).alias("n_hit"),
                   count(F.when(F.col("items").isNotNull(), F.size("items"))).alias("n_items"),
                   F.sha2(ids.cast("binary"), 256).alias("items_sha256"), count(F.col("n_near")).alias("n_near"))
    share = 100 // min_share_pct
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
