"""Stupid-backoff scores of documents by joins with n-gram count tables.

A document is scored by all the others: every count is the corpus' less its own.
A word's score is count(context word) / count(context) with the longest context,
of ``order`` - 1 words at most, for which the count is above zero, times ``BACKOFF``
for each word by which the context was shortened; without context it is
count(word) / (words of the other documents), and a word that no other document has
counts as one. A document's score is the sum of the log10.

Words are any runs of non-space bytes; n-grams travel as 64-bit hashes.

1. Documents are dealt into blocks (rows of one scan task, ``ROWS_PER_BLOCK`` at a
   time). A block's exploded n-grams are counted where they are read; its
   distinct n-grams, with counts, are packed into one row per hash partition.
   A pair that fills a third of the corpus is one entry per block.
2. Count tables are partitioned by hash: the task of a hash partition adds up
   the blocks' counts and joins the totals back to the n-grams that each block
   asked for.
3. The totals return to their block, which joins them with the n-grams of its
   documents and sums the scores per document.

Memory: one block of texts, or one hash partition of distinct n-grams, at a
time; the number of hash partitions follows the corpus' bytes. The blocks are
read twice, so ``docs`` must be a stored table (or pass ``stored=False``).

Defined results: a NULL, empty or blank text has no words and score 0; repeated
rows count as often as they occur and are scored alike; an empty table gives an
empty result; extra columns pass through, clashing names are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from costlake.llm.blocks import batch, block_id, by_part, planes, unplanes, whole_blocks
from costlake.llm.text import packed, text_of
from costlake.session import materialize

ORDER = 2                   # words of an n-gram; see README for the price of 3
BACKOFF = 0.4
ROWS_PER_BLOCK = 1536
BYTES_PER_PARTITION = 16 << 20
ANSWER_BYTES = 1 << 20      # answers that leave a task together
BYTES_PER_TASK = 64 << 20   # of texts, in a task that reads blocks with their answers
OUT = ("n_words", "n_backoff", "lm_score")

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.int64).astype(_U) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text) of a string array without nulls."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or at[-1] == at[0]:
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    b = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    word = ~_SPACE[b]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = at[(at > 0) & (at < len(b))]
    first[edges] = word[edges]
    where = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(where, at))
    if not len(where):
        return np.zeros(0, _U), counts
    kept = np.cumsum(word)
    start = kept[where] - 1
    length = np.diff(np.r_[start, kept[-1]])
    place = np.arange(kept[-1]) - np.repeat(start, length)
    power = np.cumprod(np.full(int(length.max()), _BASE, _U))
    return _mix(np.add.reduceat(_BYTE[b[word]] * power[place], start) + length.astype(_U)), counts


def ngrams(h: np.ndarray, counts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length from 1 to ``order``: (hash of each n-gram, index of its last word);
    none across texts."""
    place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    out, whole = [(h, np.arange(len(h)))], h
    for k in range(2, order + 1):
        at = np.flatnonzero(place >= k - 1)
        g = _mix(whole[at - 1] * _U(2 * k - 1) + _mix(h[at]))
        whole = np.zeros(len(h), _U)
        whole[at] = g
        out.append((g, at))
    return out


def _grams(texts: pa.Array, order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    h, counts = word_hashes(texts)
    return counts, ngrams(h, counts, order)


def _distinct(grams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A block's n-grams in hash order, and how often each occurs."""
    g, n = np.unique(np.concatenate([x for x, _ in grams]), return_counts=True)
    return g, n.astype(np.uint32)


_ASKED = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary()),
                    ("words", pa.int64())])
_TOLD = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("totals", pa.binary()), ("check", pa.int64())])


def checksum(grams: np.ndarray) -> int:
    """64-bit sum over distinct n-grams; those of the parts add up to the block's."""
    return int(_mix(grams ^ _BASE).sum(dtype=_U).astype(np.int64))


def _ask(parts: int, order: int = ORDER):
    """Per block and hash partition: its distinct n-grams and their counts."""
    shift = _U(64 - (parts - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in whole_blocks(batches):
            counts, grams = _grams(table["text"].combine_chunks(), order)
            g, n = _distinct(grams)
            part = (g >> shift).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(g) else []
            rows = [(block, int(part[i]), planes(np.diff(g[i:j], prepend=_U(0))), planes(n[i:j]), int(counts.sum()) if i == 0 else 0)
                    for i, j in zip(cut, [*cut[1:], len(g)])]
            if rows:
                yield batch(_ASKED, rows)

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of one hash partition after the other, joined back to each block's
    n-grams, in the order in which the block asked."""
    for held in by_part(batches):
        asked = [np.cumsum(unplanes(r[2], np.uint64), dtype=_U) for r in held]
        g, at = np.unique(np.concatenate(asked), return_inverse=True)
        n = np.bincount(at, np.concatenate([unplanes(r[3], np.uint32) for r in held]), len(g)).astype(np.uint64)
        rows, size = [], 0
        for r, own in zip(held, asked):      # a batch costs far more than a row
            rows.append((r[0], r[1], planes(n[np.searchsorted(g, own)]), checksum(own)))
            size += 8 * len(own) + 32
            if size > ANSWER_BYTES:
                yield batch(_TOLD, rows)
                rows, size = [], 0
        if rows:
            yield batch(_TOLD, rows)


def score_block(texts: pa.Array, totals: np.ndarray, n: int, checks: list[int], order: int = ORDER) -> tuple[np.ndarray, ...]:
    """(words, backed-off words, score) of each text of a block, given the corpus
    totals of its distinct n-grams in hash order and the checksums of the n-grams
    that were answered."""
    counts, by_length = _grams(texts, order)
    grams, _ = _distinct(by_length)
    if len(grams) != len(totals) or (checksum(grams) - sum(checks)) % (1 << 64):
        raise ValueError("a block changed between its two reads: pass stored=False")
    doc = np.repeat(np.arange(len(counts)), counts)
    size = len(doc)
    # Per length and word: occurrences in other documents of the n-gram that ends there.
    others = []
    for g, at in by_length:
        of = np.searchsorted(grams, g)
        _, which, own = np.unique(doc[at] * max(len(grams), 1) + of, return_inverse=True, return_counts=True)
        here = np.zeros(size)
        here[at] = totals[of].astype(float) - own[which]
        others.append(here)
    rest = np.maximum(float(n) - counts, 1.0)[doc]
    place = np.arange(size) - np.repeat(np.cumsum(counts) - counts, counts)
    longest = np.minimum(place + 1, order)
    p = BACKOFF ** (longest - 1.0) * np.maximum(others[0], 1.0) / rest
    found = np.where(others[0] > 0, 1, 0)
    for k in range(2, order + 1):
        hit = np.flatnonzero(others[k - 1] > 0)
        p[hit] = BACKOFF ** (longest[hit] - float(k)) * others[k - 1][hit] / others[k - 2][hit - 1]
        found[hit] = k
    back = (np.maximum(found, 1) < longest).astype(float)
    return counts, np.bincount(doc, back, len(counts)).astype(np.int64), np.bincount(doc, np.log10(p), len(counts))


def lm_scores(docs: DataFrame, text: str = "text", stored: bool = True, drop_text: bool = False,
              rows_per_block: int = ROWS_PER_BLOCK, order: int = ORDER) -> DataFrame:
    """``docs`` with n_words, n_backoff (words scored by backing off) and
    lm_score (sum of log10 scores)."""
    spark = docs.sparkSession
    if not stored:
        docs = materialize(docs)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_of(text))), F.lit(0))).first()[0]
    if not size:
        out = docs.select(packed(docs, (*OUT, text) if drop_text else OUT))
        none = F.lit(0).cast("bigint")
        return out.select("_doc.*", none.alias("n_words"), none.alias("n_backoff"), F.lit(0.0).alias("lm_score"))
    parts = 1 << max(4, (int(size) // BYTES_PER_PARTITION).bit_length())
    rows = docs.select(block_id(rows_per_block).alias("block"), text_of(text).alias("text"),
                       packed(docs, (*OUT, text) if drop_text else OUT))
    seen = Observation(f"ngram-words-{uuid.uuid4().hex[:8]}")
    asked = rows.select("block", "text").mapInArrow(
        _ask(parts, order), "block bigint, part bigint, grams binary, counts binary, words bigint") \
        .observe(seen, F.coalesce(F.sum("words"), F.lit(0)).alias("n"))
    dealt = asked.repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
    told = materialize(dealt.sortWithinPartitions("part")
                       .mapInArrow(_answer, "block bigint, part bigint, totals binary, check bigint"))
    n = seen.get["n"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name == "_doc")
    schema = pa.schema([("n_words", pa.int64()), ("n_backoff", pa.int64()), ("lm_score", pa.float64())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        told = sorted(zip(right["part"].to_pylist(), right["totals"].to_pylist()))
        totals = np.concatenate([np.zeros(0, _U), *[unplanes(t, np.uint64) for _, t in told]])
        texts = left["text"].combine_chunks() if left.num_rows else pa.array([], pa.string())
        cols = score_block(texts, totals, n, right["check"].to_pylist(), order)
        return pa.table([left["_doc"], *[pa.array(x, f.type) for x, f in zip(cols, schema, strict=True)]],
                        names=["_doc", *schema.names])

    # Blocks meet their answers in as many tasks as the bytes ask for.
    near = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // BYTES_PER_TASK)
    out = rows.repartition(near, "block").groupBy("block").cogroup(told.repartition(near, "block").groupBy("block")).applyInArrow(
        score, f"{kinds}, n_words bigint, n_backoff bigint, lm_score double")
    return out.select("_doc.*", "n_words", "n_backoff", "lm_score")
