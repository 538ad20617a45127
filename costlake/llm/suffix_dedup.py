"""Exact substring dedup by suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. Sorting every suffix of the corpus would move
each byte many times over, so the strings are first narrowed, without loss:

1. Every window of ``LENGTH`` bytes is named by its minimiser, the smallest hash
   of the ``GRAM``-byte strings in it. Equal windows have equal minimisers; runs
   of windows with one minimiser are about one per 18 bytes. Blocks of documents
   send their distinct minimisers (packed) to hash partitions, which answer
   which of them occur in more than one document. Both sides are measured in
   bytes, as they exchange one row per block and partition.
2. The runs of windows with a shared minimiser are cut out as segments; equal
   segments of a block are sent once, with their smallest doc_id, to the shard
   of their minimiser. A minimiser of very many documents has its windows sent
   one by one, each to the shard of its own hash, so a passage that a third of
   all documents share is spread out, and collapses to one row per block.
3. Each shard holds every distinct segment once. Its windows are narrowed again,
   without loss, to those whose hash occurs twice. Of their bytes it builds suffix
   arrays of at most ``SHARD_BYTES`` (Larsson-Sadakane),
   finds equal windows as runs of common prefixes of ``LENGTH`` or more (Kasai),
   and merges its arrays by binary search of the distinct windows of one in
   those of the others. It answers, per window, whether a smaller doc_id has it.
4. Each block marks the covered bytes of its documents.

Memory: one block of texts, one minimiser partition or one shard array at a
time. The blocks are read three times, so ``docs`` must be a stored table (or
pass ``stored=False``).

Defined results: a NULL text is empty; documents with equal doc_ids do not
remove each other's bytes; a NULL doc_id counts as larger than any other; an
empty table gives an empty result; extra columns pass through, clashing names
are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.blocks import batch, block_id, by_part, planes, unplanes, whole_blocks
from costlake.llm.suffix_array import find_rows, kasai, ranked_suffixes
from costlake.llm.text import packed, text_of
from costlake.session import materialize

LENGTH = 50
GRAM = 16
BLOCK_BYTES = 16 << 20      # of texts of mean size, in a block
BLOCK_MOST = 48 << 20       # of texts of the size that a byte's text has on average (long ones may stand together)
BLOCK_ROWS = 1 << 16
PIECE_BYTES = 1 << 17
RUNS_AT_ONCE = 1 << 15
SHARD_BYTES = 2 << 20
BYTES_PER_PARTITION = 32 << 20
ANSWER_BYTES = 1 << 20      # answers that leave a task together
BYTES_PER_TASK = 64 << 20   # of texts, in a task that reads blocks with their answers
HOT_DOCS = 16_000           # a minimiser of more documents (1 MB of a shard) has its windows dealt one by one
NO_ID = (1 << 63) - 1
OUT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")

_U = np.uint64
_ASKED = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("grams", pa.binary()), ("low", pa.binary()),
                    ("spread", pa.binary()), ("docs", pa.binary())])
_TOLD = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("answer", pa.binary())])
_CUT = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("data", pa.binary()), ("sizes", pa.binary()),
                  ("low", pa.binary())])
_DDL = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


class Runs:
    """The windows of one block's documents, as runs with one minimiser."""

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        texts = texts.cast(pa.large_binary())
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
            if len(texts) else np.zeros(1, np.int64)
        body = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(body, np.uint8)[at[0]:at[-1]] if body is not None else np.zeros(0, np.uint8)
        self.at, self.ids = at - at[0], ids
        runs = [np.zeros((0, 3), np.int64)]
        marks = [np.zeros(0, _U)]
        doc = 0
        while doc < len(ids):       # pieces of whole documents
            end = max(doc + 1, int(np.searchsorted(self.at, self.at[doc] + PIECE_BYTES, "right")) - 1)
            r, m = self._piece(doc, min(end, len(ids)))
            runs.append(r)
            marks.append(m)
            doc = min(end, len(ids))
        r = np.concatenate(runs)
        self.start, self.count, self.doc = r[:, 0], r[:, 1], r[:, 2]
        self.mark = np.concatenate(marks)
        self.low = ids[self.doc]
        self.grams, self.of = np.unique(self.mark, return_inverse=True)

    def _piece(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        base, stop = int(self.at[first]), int(self.at[end])
        b = self.data[base:stop]
        n_win = np.maximum(np.diff(self.at[first:end + 1]) - (LENGTH - 1), 0)
        if not n_win.sum():
            return np.zeros((0, 3), np.int64), np.zeros(0, _U)
        x = np.ndarray((len(b) - 7,), "<u8", b.tobytes(), 0, (1,)).astype(_U)     # eight bytes from each place
        g = x[:-8] * _U(0x9E3779B97F4A7C15) + (x[8:] ^ (x[8:] >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        g ^= g >> _U(32)
        g *= _U(0x94D049BB133111EB)
        g ^= g >> _U(29)
        width, have = LENGTH - GRAM + 1, 1
        while have < width:          # sliding minimum by doubling
            h = min(have, width - have)
            g = np.minimum(g[:-h], g[h:])
            have += h
        doc = np.repeat(np.arange(first, end), n_win)
        skip = np.repeat(self.at[first:end] - base - (np.cumsum(n_win) - n_win), n_win)
        p = np.arange(len(doc)) + skip
        m = g[p]
        new = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (doc[1:] != doc[:-1])])
        count = np.diff(np.r_[new, len(m)])
        # Minima crowd at small values; an odd factor spreads them over the parts.
        return np.stack([p[new] + base, count, doc[new]], axis=1), m[new] * _U(0x9E3779B97F4A7C15)

    def minimisers(self, shift: int) -> list[tuple]:
        """(part, grams, low, spread, docs): the block's distinct minimisers with
        their smallest doc_id, largest minus smallest, and number of runs."""
        if not len(self.grams):
            return []
        low, high = np.full(len(self.grams), NO_ID, np.int64), np.full(len(self.grams), -NO_ID - 1, np.int64)
        np.minimum.at(low, self.of, self.low)
        np.maximum.at(high, self.of, self.low)
        docs = np.bincount(self.of).astype(np.uint32)
        part = (self.grams >> _U(shift)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        return [(int(part[i]), planes(np.diff(self.grams[i:j], prepend=_U(0))), planes(low[i:j]),
                 planes(high[i:j] - low[i:j]), planes(docs[i:j])) for i, j in zip(first, [*first[1:], len(part)])]

    def entries(self, status: np.ndarray, shift: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, ...]:
        """Distinct segments (and, of hot minimisers, single windows) of the block:
        their bytes, windows, smallest doc_id and part; then, per use of an entry, the
        entry, its first window's position, its windows and its document."""
        s = status[self.of]
        plain, hot = np.flatnonzero(s == 1), np.flatnonzero(s == 2)
        n = self.count[hot]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.r_[self.start[plain], np.repeat(self.start[hot], n) + step]
        count = np.r_[self.count[plain], np.ones(len(step), np.int64)]
        doc = np.r_[self.doc[plain], np.repeat(self.doc[hot], n)]
        raw = self.data.tobytes()
        seen: dict[bytes, int] = {}      # a segment and a window of a hot minimiser are never equal
        entry = np.array([seen.setdefault(raw[p:q], len(seen))
                          for p, q in zip(start.tolist(), (start + count + LENGTH - 1).tolist())], np.int64)
        texts = list(seen)
        first = np.flatnonzero(np.diff(np.maximum.accumulate(entry), prepend=-1)) if len(entry) else entry
        of_plain = first[first < len(plain)]
        mask = (1 << (64 - shift)) - 1
        part = np.r_[(self.mark[plain[of_plain]] >> _U(shift)).astype(np.int64),
                     np.array([zlib.crc32(t) & mask for t in texts[len(of_plain):]], np.int64)]
        low = np.full(len(texts), NO_ID, np.int64)
        np.minimum.at(low, entry, self.ids[doc])
        return texts, count[first], low, part, entry, start, count, doc


def _shift(parts: int) -> int:
    return 64 - (parts - 1).bit_length()


def _block_rows(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.binary())
    return table["id"].to_numpy(), texts


def _ask(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in whole_blocks(batches):
            rows = [(block, *r) for r in Runs(*_block_rows(table)).minimisers(_shift(parts))]
            if rows:
                yield batch(_ASKED, rows)
    return run


def _answers(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Answer rows in batches of about ``ANSWER_BYTES``: blocks and partitions
    exchange many small rows, and a batch costs far more than a row."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[3]) + 32
        if size > ANSWER_BYTES:
            yield batch(_TOLD, held)
            held, size = [], 0
    if held:
        yield batch(_TOLD, held)


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and minimiser: 0 in one document only, 1 shared, 2 hot."""
    yield from _answers(_tell_rows(batches))


def _tell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for held in by_part(batches):
        asked = [np.cumsum(unplanes(r[2], np.uint64), dtype=_U) for r in held]
        g, at = np.unique(np.concatenate(asked), return_inverse=True)
        low, high = np.full(len(g), NO_ID, np.int64), np.full(len(g), -NO_ID - 1, np.int64)
        lows = [unplanes(r[3], np.int64) for r in held]
        np.minimum.at(low, at, np.concatenate(lows))
        np.maximum.at(high, at, np.concatenate([x + unplanes(r[4], np.int64) for x, r in zip(lows, held)]))
        docs = np.bincount(at, np.concatenate([unplanes(r[5], np.uint32) for r in held]), len(g))
        status = np.where(low == high, 0, np.where(docs > HOT_DOCS, 2, 1)).astype(np.uint8)[at]
        ends = np.cumsum([len(own) for own in asked])
        for r, own, end in zip(held, asked, ends):
            yield r[0], 0, r[1], status[end - len(own):end].tobytes()


def _status(told: list[tuple[int, int, bytes]]) -> np.ndarray:
    mine = sorted((p, a) for k, p, a in told if k == 0)
    return np.frombuffer(b"".join(a for _, a in mine), np.uint8)


def _checked(runs: Runs, status: np.ndarray) -> np.ndarray:
    if len(status) != len(runs.grams):
        raise ValueError("a block changed between its reads: pass stored=False")
    return status


def _told_rows(t: pa.Table) -> list[tuple[int, int, bytes]]:
    return list(zip(t["kind"].to_pylist(), t["part"].to_pylist(), t["answer"].to_pylist()))


def _cut(parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([], _CUT)
        runs = Runs(*_block_rows(left))
        texts, wins, low, part, *_ = runs.entries(_checked(runs, _status(_told_rows(right))), _shift(parts))
        block, rows, squeeze = left["block"][0].as_py(), [], zstandard.ZstdCompressor(level=1)
        order = np.argsort(part, kind="stable")
        p = part[order]
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else []
        for i, j in zip(first, [*first[1:], len(p)]):
            own = order[i:j]
            rows.append((block, int(p[i]), squeeze.compress(b"".join([texts[e] for e in own.tolist()])),
                         planes((wins[own] + LENGTH - 1).astype(np.uint32)), planes(low[own])))
        return pa.Table.from_batches([batch(_CUT, rows)], _CUT)
    return run


def window_hashes(data: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every window of ``length`` bytes inside the segments of ``data`` (in order)."""
    ends, n_win = np.cumsum(sizes), np.maximum(sizes - (length - 1), 0)
    out, done, s = np.empty(n_win.sum(), _U), 0, 0
    while s < len(sizes):                      # pieces of whole segments
        base = int(ends[s] - sizes[s])
        e = max(s + 1, int(np.searchsorted(ends, base + PIECE_BYTES, "right")))
        n = n_win[s:e]
        piece = data[base:int(ends[e - 1])].tobytes() + bytes(8)
        x = np.ndarray((len(piece) - 7,), "<u8", piece, 0, (1,)).astype(_U)
        if length < 8:
            x &= _U((1 << 8 * length) - 1)
        p = np.arange(n.sum()) + np.repeat((ends - sizes)[s:e] - base - (np.cumsum(n) - n), n)
        h = x[p] * _U(0x9E3779B97F4A7C15)
        for more in [*range(8, length - 7, 8), *([length - 8] if length > 8 and length % 8 else [])]:
            h ^= h >> _U(29)
            h += x[p + more]
            h *= _U(0xBF58476D1CE4E5B9)
        out[done:done + len(h)] = h ^ (h >> _U(32))
        done, s = done + len(h), e
    return out


def repeated(hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes occur more than once; some that do not may be told too."""
    bits = _U(len(hashes).bit_length())        # the place takes a hash's last bits
    key = np.sort((hashes >> bits << bits) | np.arange(len(hashes), dtype=_U))
    same = np.r_[False, key[1:] >> bits == key[:-1] >> bits, False]
    out = np.zeros(len(hashes), bool)
    out[(key & ((_U(1) << bits) - _U(1))).astype(np.int64)] = same[1:] | same[:-1]
    return out


def smallest_holder(data: np.ndarray, sizes: np.ndarray, low: np.ndarray, length: int = LENGTH,
                    shard_bytes: int | None = None) -> np.ndarray:
    """For every window of ``length`` bytes inside the segments of ``data`` (in
    order): the smallest ``low`` of any segment that holds it. Equal windows have
    equal hashes, so a window whose hash is the only one of its kind has its own; the
    others are compared, as the segments of windows that they make up."""
    n_win = np.maximum(sizes - (length - 1), 0)
    out = np.repeat(low, n_win)
    if not len(out):
        return out
    at = np.flatnonzero(repeated(window_hashes(data, sizes, length)))
    seg = np.repeat(np.arange(len(sizes)), n_win)[at]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (seg[1:] != seg[:-1])]) if len(at) else at
    own = np.diff(np.r_[new, len(at)]) + length - 1
    first = (np.cumsum(sizes) - sizes - (np.cumsum(n_win) - n_win))[seg[new]] + at[new]
    where = np.arange(own.sum()) + np.repeat(first - (np.cumsum(own) - own), own)
    out[at] = _by_suffix_arrays(data[where], own, low[seg[new]], length, shard_bytes or SHARD_BYTES)
    return out


def _by_suffix_arrays(data: np.ndarray, sizes: np.ndarray, low: np.ndarray, length: int, shard_bytes: int) -> np.ndarray:
    """``smallest_holder`` of segments whose windows are all compared."""
    ends = np.cumsum(sizes)
    n_win = np.maximum(sizes - (length - 1), 0)
    out = np.repeat(low, n_win)
    first_win = np.cumsum(n_win) - n_win
    arrays = []
    s = 0
    while s < len(sizes):
        base = int(ends[s] - sizes[s])
        e = max(s + 1, int(np.searchsorted(ends, base + shard_bytes, "right")))
        d = data[base:int(ends[e - 1])]
        # A byte serves windows up to its segment's end only.
        left = np.repeat(ends[s:e] - base, sizes[s:e]) - np.arange(len(d))
        sa, rank = ranked_suffixes(d, length, np.minimum(left, length))
        win = np.full(len(d), -1, np.int64)
        at = np.arange(first_win[s], first_win[e - 1] + n_win[e - 1])
        where = np.repeat((ends - sizes)[s:e] - base, n_win[s:e]) + at - np.repeat(first_win[s:e], n_win[s:e])
        win[where] = at
        pos = sa[win[sa] >= 0]                 # windows inside one segment
        group, who = np.cumsum(kasai(d, pos, length, rank) < length) - 1, win[pos]
        new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        least = np.minimum.reduceat(out[who], new) if len(new) else np.zeros(0, np.int64)
        arrays.append((d, pos[new] if len(new) else new, least, who, np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(group)]))))
        s = e
    if len(arrays) > 1:                        # merge the arrays by binary search
        keys = [np.lib.stride_tricks.sliding_window_view(d, length)[p] if len(p) else np.zeros((0, length), np.uint8)
                for d, p, *_ in arrays]
        for i in range(len(arrays)):
            for j in range(i + 1, len(arrays)):
                hit = find_rows(keys[i], keys[j])
                b = np.flatnonzero(hit >= 0)
                both = np.minimum(arrays[i][2][hit[b]], arrays[j][2][b])
                arrays[i][2][hit[b]] = both
                arrays[j][2][b] = both
    for _, _, least, who, cls in arrays:
        out[who] = least[cls]
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _answers(_judge_rows(batches))


def _judge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for held in by_part(batches):
        # Equal segments of several blocks are one segment of the shard.
        seen: dict[bytes, int] = {}
        which, lows, sizes = [], [], []
        for r in held:
            raw = zstandard.decompress(r[2])
            sizes.append(unplanes(r[3], np.uint32).astype(np.int64))
            lows.append(unplanes(r[4], np.int64))
            ends = np.cumsum(sizes[-1]).tolist()
            which.append(np.array([seen.setdefault(raw[i:j], len(seen)) for i, j in zip([0, *ends], ends)], np.int64))
        low = np.full(len(seen), NO_ID, np.int64)
        np.minimum.at(low, np.concatenate(which), np.concatenate(lows))
        own, data = np.array([len(k) for k in seen], np.int64), np.frombuffer(b"".join(seen), np.uint8)
        del seen
        least = smallest_holder(data, own, low)
        n_win = own - (LENGTH - 1)
        first = np.cumsum(n_win) - n_win
        for r, e, low_here in zip(held, which, lows):
            n = n_win[e]
            at = np.arange(n.sum()) + np.repeat(first[e] - (np.cumsum(n) - n), n)
            yield r[0], 1, r[1], np.packbits(least[at] < np.repeat(low_here, n)).tobytes()


def removed_mask(runs: Runs, told: list[tuple[int, int, bytes]], parts: int) -> np.ndarray:
    """Which bytes of the block are covered by a window of a smaller doc_id."""
    texts, n_win, low, part, entry, start, count, doc = runs.entries(_checked(runs, _status(told)), _shift(parts))
    if not texts:
        return np.zeros(len(runs.data), bool)
    order = np.argsort(part, kind="stable")
    used, n_of = np.unique(part, return_inverse=True)
    n_bits = np.bincount(n_of, n_win).astype(np.int64)
    got = {p: a for k, p, a in told if k == 1}
    bits = np.concatenate([np.unpackbits(np.frombuffer(got[int(p)], np.uint8), count=int(n))
                           for p, n in zip(used, n_bits)]).astype(bool)
    offset = np.empty(len(texts), np.int64)
    offset[order] = np.cumsum(n_win[order]) - n_win[order]
    gone = np.zeros(len(runs.data), bool)
    for i in range(0, len(entry), RUNS_AT_ONCE):
        of, n = entry[i:i + RUNS_AT_ONCE], count[i:i + RUNS_AT_ONCE]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        larger = runs.ids[doc[i:i + RUNS_AT_ONCE]] > low[of]
        hit = bits[np.repeat(offset[of], n) + step] | np.repeat(larger, n)
        gone[(np.repeat(start[i:i + RUNS_AT_ONCE], n) + step)[hit]] = True
    have = 1
    while have < LENGTH:            # a window that begins here covers so many bytes
        h = min(have, LENGTH - have)
        wider = gone.copy()
        wider[h:] |= gone[:-h]
        gone, have = wider, have + h
    return gone


def _mark(parts: int, keep_text: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        runs = Runs(*_block_rows(left))
        gone = removed_mask(runs, _told_rows(right), parts)
        rows = []
        for a, b in zip(runs.at[:-1], runs.at[1:]):
            g = gone[a:b]
            kept = runs.data[a:b][~g].tobytes()
            spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
            rows.append((int(b - a), int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        cols = [pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)]
        return pa.table([left["_doc"], *cols], names=["_doc", *OUT])
    return run


def block_rows(n: int, size: float, squares: float) -> int:
    """Rows of a block: ``n`` texts have ``size`` bytes, and their sizes' squares add up to ``squares``."""
    return BLOCK_ROWS if not size else max(1, min(BLOCK_ROWS, int(BLOCK_BYTES * n / size), int(BLOCK_MOST * size / squares)))


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", stored: bool = True,
                     drop_text: bool = False, rows_per_block: int | None = None) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256
    and kept (the remaining bytes; NULL with ``drop_text``). Blocks have about
    ``BLOCK_BYTES``, if their rows are not given."""
    spark = docs.sparkSession
    if not stored:
        docs = materialize(docs)
    long = F.octet_length(text_of(text)).cast("double")
    n, size, squares = docs.agg(F.count("*"), F.coalesce(F.sum(long), F.lit(0.)), F.coalesce(F.sum(long * long), F.lit(0.))).first()
    rows_per_block = rows_per_block or block_rows(n, size, squares)
    parts = 1 << max(4, (int(size) // BYTES_PER_PARTITION).bit_length())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(block_id(rows_per_block).alias("block"),
                       F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("id"),
                       text_of(text).cast("binary").alias("text"),
                       packed(docs, (*OUT, text) if drop_text else OUT))
    plain = rows.select("block", "id", "text")
    asked = plain.mapInArrow(_ask(parts), _ddl(_ASKED))
    told = materialize(asked.repartitionById(parts, F.col("part").cast("int")).mapInArrow(_tell, _ddl(_TOLD)))
    # Blocks meet their answers in as many tasks as the bytes ask for.
    near = max(tasks, int(size) // BYTES_PER_TASK)
    cut = plain.repartition(near, "block").groupBy("block").cogroup(told.repartition(near, "block").groupBy("block")).applyInArrow(_cut(parts), _ddl(_CUT))
    judged = materialize(cut.repartitionById(parts, F.col("part").cast("int")).mapInArrow(_judge, _ddl(_TOLD)))
    kind = rows.schema["_doc"].dataType.simpleString()
    answers = told.unionByName(judged).repartition(near, "block")
    out = rows.repartition(near, "block").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _mark(parts, not drop_text),
        f"_doc {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return out.select("_doc.*", *OUT)
