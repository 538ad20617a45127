"""Cross-tokenizer alignment, each distinct text once.

1. The documents are shuffled by their full text (counted on the map side, so
   a text that a third of the rows share arrives as few rows); every distinct text
   has its number of documents and, as its id, its SHA-256.
2. ``align_texts``: both tokenizers run once on each distinct text. Byte offsets
   where tokens of both end cut them into groups; a group links each of its A
   tokens with each of its B tokens. The distinct id pairs of a text are
   kept with their number of occurrences, packed in one row.
3. ``pair_counts``: documents by pair, weighted by the texts' multiplicities
   (partial sums before the shuffle), and whether the pair is its A id's best.
4. ``measure``: the pairs meet these counts, and the measures go to every
   document by its text's id. Pairs are broadcast in order of magnitude of
   their count, as many as ``MAX_BROADCAST_ROWS`` allow; only the rarer ones are
   shuffled, and as rare ones they have no hot key.

Defined results: NULL or empty texts, and texts that either tokenizer does not give
back byte for byte, have no tokens (zeros and the empty string); repeated rows
count as documents of their own and each get the same row; very long texts are
aligned whole; an empty table gives no rows; extra columns pass through, clashing
names are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.piece_encoding import chunks
from costlake.llm.piece_model import NO_NORMALIZER, SPACE_MARK, Normaliser, is_bpe
from costlake.llm.text import packed, text_of
from costlake.session import materialize

CHUNK_BYTES = 1 << 19
WIDE = 8                           # tokens on both sides of a group whose equal ids are counted first
MAX_LINKS = 1 << 21                # pairs of ids that are spelt out at a time
MAX_BROADCAST_ROWS = 1_000_000     # pair counts, 17 bytes each
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
# Fixed value: the pattern that splits a text before byte-level merges.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_BLANK = re.compile(r"\s{1000}")
ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


class Pieces:
    """Token bytes by id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = np.cumsum(size) - size
        return self.bytes[np.repeat(self.start[ids] - at, size) + np.arange(int(size.sum()))]


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes
    stand for themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(c): b for c, b in [*zip(plain, plain), *zip(range(256, 256 + len(rest)), rest)]}


class WordPieces:
    """Ids of a sentencepiece model, by words.

    Where no piece of a BPE vocabulary has a space mark behind another character, no
    merge crosses the start of a run of spaces, so a text's ids are those of its
    words, and each distinct word is segmented once. Words beyond ``LONG``
    characters are not kept, and the memory is emptied at ``KEPT`` words."""

    LONG, KEPT = 64, 1 << 19

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        normal = Normaliser(model)
        self.whole = SentencePieceProcessor(model_proto=model)
        self.plain = SentencePieceProcessor(model_proto=model + NO_NORMALIZER)
        pieces = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        self.by_word = (is_bpe(model) and normal.map is None and normal.symbols is None and normal.prefix and normal.escape
                        and not normal.squeeze and not normal.as_suffix
                        and not any(re.search("[^▁]▁", p) for p in pieces))
        self.words = re.compile("▁*[^▁]+|▁+")
        self.known: dict[str, list[int]] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [i.astype(np.int64) for i in self.whole.encode(texts, num_threads=1, return_type="numpy")]
        split = [self.words.findall("▁" + t.replace(" ", "▁")) if t else [] for t in texts]
        known = self.known
        if len(known) > self.KEPT:
            known.clear()
        new = list({w for words in split for w in words if w not in known})
        here = dict(zip(new, self.plain.encode(new, num_threads=1))) if new else {}
        known.update((w, i) for w, i in here.items() if len(w) <= self.LONG)
        here = {w: i for w, i in here.items() if len(w) > self.LONG}
        find = known.__getitem__ if not here else lambda w: known.get(w) or here[w]
        return [np.fromiter(chain.from_iterable(map(find, words)), np.int64) for words in split]


class BytePairs:
    """Ids of a byte-level tokenizer file.

    The file's merges are also run by a second, faster library over its rank order.
    The two differ at most in how they class rare characters, so only texts whose
    characters have kept their class since Unicode 3.2 go that way (and no very long
    blanks, on which the second one fails), and others to the file's own library. A file that is not plain byte-level BPE (its pattern, no
    normaliser, ids in order of the merges) always takes its own library."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(file.decode())
        self.own.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.names = self.own.get_vocab()
        self.bytes = [b""] * (max(self.names.values()) + 1)
        for name, i in self.names.items():
            self.bytes[i] = bytes(alphabet.get(c, 0) for c in name)
        self.fast = self._ranks(json.loads(file))
        self.safe: set[str] = set()

    def _ranks(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {self.bytes[i]: i for n, i in self.names.items() if n not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        in_order = [self.names.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges)))
        plain = (model["type"] == "BPE" and in_order and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
                 and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and len(ranks) == 256 + len(merges))
        if not plain:
            return None
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _settled(self, text: str) -> bool:
        if self.safe.issuperset(text):
            return True
        old = unicodedata.ucd_3_2_0
        fresh = {c for c in set(text) - self.safe if unicodedata.category(c) == old.category(c) not in ("Cn", "Cc", "Cs", "Co")
                 or c in "\t\n\r"}
        self.safe |= fresh
        return self.safe.issuperset(text)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        slow = []
        for k, t in enumerate(texts):
            if self.fast is not None and self._settled(t) and not LONG_BLANK.search(t):
                out[k] = np.array(self.fast.encode_ordinary(t), np.int64)
            else:
                slow.append(k)
        if slow:
            for k, e in zip(slow, self.own.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False)):
                out[k] = np.array(e.ids, np.int64)
        return out


class Aligner:
    """Aligns texts by a byte-level tokenizer (A, JSON file) and a sentencepiece
    model (B) that both encode the text behind one space."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = BytePairs(a), WordPieces(b)
        self.a_pieces = Pieces(self.a.bytes)
        p = self.b.whole
        n = p.get_piece_size()
        self.b_pieces = Pieces([bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i)
                                else p.id_to_piece(i).encode().replace(SPACE_MARK, b" ") for i in range(n)])
        # Ids as text, with what follows them: another of their kind, or the other side.
        self.na, self.nb = len(self.a.bytes), n
        ends = [(self.na, ","), (self.na, "|"), (n, ","), (n, ";")]
        self.spelt = np.array([f"{i}{end}" for size, end in ends for i in range(size)], object)

    def _tokens(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides, empty where either does not give the text back."""
        given = [t.decode() for t in texts]
        a, b = self.a([" " + t if t else "" for t in given]), self.b(given)
        whole = b"".join(b" " + t for t in texts if t)
        if all(self._spells(np.concatenate(ids), pieces, whole) for ids, pieces in ((a, self.a_pieces), (b, self.b_pieces))):
            return a, b
        for k, t in enumerate(texts):
            if not t or not (self._spells(a[k], self.a_pieces, b" " + t) and self._spells(b[k], self.b_pieces, b" " + t)):
                a[k] = b[k] = np.zeros(0, np.int64)
        return a, b

    @staticmethod
    def _spells(ids: np.ndarray, pieces: Pieces, want: bytes) -> bool:
        size = pieces.size[ids]
        return int(size.sum()) == len(want) and pieces.spell(ids, size).tobytes() == want

    def _pairs(self, doc: np.ndarray, ga: np.ndarray, a: np.ndarray, gb: np.ndarray, b: np.ndarray,
               n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, pair, times) of the linked ids of each document, in order.

        In a group of many tokens equal ids are counted first, so it costs its
        distinct ids; the links are spelt out ``MAX_LINKS`` at a time."""
        in_a, in_b = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
        wide = (in_a > WIDE) & (in_b > WIDE)
        sides = [((ga, a, np.ones(len(a), np.int64)), (gb, b, np.ones(len(b), np.int64)))]
        if wide.any():
            wa, wb = wide[ga], wide[gb]
            sides = [tuple((g[~w], i[~w], t[~w]) for (g, i, t), w in zip(sides[0], (wa, wb))),
                     (_distinct(ga[wa], a[wa], self.na), _distinct(gb[wb], b[wb], self.nb))]
        got = []
        for (ga, a, ta), (gb, b, tb) in sides:
            first_b = np.searchsorted(gb, np.arange(n_groups + 1))
            width = np.diff(first_b)[ga]
            done = np.cumsum(width)
            i = 0
            while i < len(a):
                j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + MAX_LINKS, "right")))
                w = width[i:j]
                left = np.repeat(np.arange(i, j), w)
                right = np.repeat(first_b[ga[i:j]] - (np.cumsum(w) - w), w) + np.arange(int(w.sum()))
                key = (doc[ga[left]] * self.na + a[left]) * self.nb + b[right]
                got.append(_summed(key, ta[left] * tb[right]))
                i = j
        if not got:
            return (np.zeros(0, np.int64),) * 3
        key, times = got[0] if len(got) == 1 else _summed(*(np.concatenate(c) for c in zip(*got)))
        left, b = np.divmod(key, self.nb)
        doc, a = np.divmod(left, self.na)
        return doc, a << 32 | b, times

    def __call__(self, texts: list[bytes]) -> dict[str, list]:
        a_lists, b_lists = self._tokens(texts)
        a, b = np.concatenate(a_lists), np.concatenate(b_lists)
        # One ruler for all texts: token ends as places in their concatenation.
        end_a, end_b = np.cumsum(self.a_pieces.size[a]), np.cumsum(self.b_pieces.size[b])
        at_a, at_b = (np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool) for _ in range(2))
        at_a[end_a], at_b[end_b] = True, True
        cut_a, cut_b = at_b[end_a], at_a[end_b]
        ga, gb = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n = int(cut_a.sum())
        in_a, in_b = np.bincount(ga, minlength=n), np.bincount(gb, minlength=n)
        size_a = np.array([len(x) for x in a_lists])
        last = np.cumsum(size_a)
        groups = np.diff(np.r_[0, np.where(last > 0, ga[last - 1] + 1, 0) if len(a) else np.zeros(len(texts), np.int64)])
        doc = np.repeat(np.arange(len(texts)), groups)
        links = np.bincount(doc, in_a * in_b, len(texts)).astype(np.int64)
        # A group's A tokens come before its B tokens.
        word = np.empty(len(a) + len(b), np.int64)
        word[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[ga]] = a + cut_a * self.na
        word[np.arange(len(b)) + np.cumsum(in_a)[gb]] = 2 * self.na + b + cut_b * self.nb
        size = size_a + np.array([len(x) for x in b_lists])
        text_at = np.cumsum(size) - size
        digests = [hashlib.sha256("".join(self.spelt[word[i:i + m]])[:-1].encode()).hexdigest() if m else ""
                   for i, m in zip(text_at.tolist(), size.tolist())]
        at, pair, times = self._pairs(doc, ga, a, gb, b, n)
        bounds = np.searchsorted(at, np.arange(len(texts) + 1))
        return {"n_a": size_a, "n_b": size - size_a, "n_groups": groups, "n_links": links, "groups_sha256": digests,
                "pairs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pair)),
                "times": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(times.astype(np.int32)))}


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if (times == 1).all():
        return np.unique(key, return_counts=True)
    order = np.argsort(key)
    key, times = key[order], times[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(times, first)


def _distinct(group: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) in order, with their numbers."""
    key, times = np.unique(group * n + ids, return_counts=True)
    return key // n, key % n, times


@lru_cache(maxsize=1)
def _aligner(a: bytes, b: bytes) -> Aligner:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # one core a task
    return Aligner(a, b)


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text, n_docs) of the texts that can have tokens."""
    return (docs.select(F.col(text).alias("text")).filter("text <> ''")
            .groupBy("text").agg(F.count(F.lit(1)).alias("n_docs")))


def text_id(c: Column) -> Column:
    return F.unhex(F.sha2(c.cast("binary"), 256))


def align_texts(texts: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """(tid, n_docs, measures of the text alone, pairs, times), stored. A pair is
    A id * 2^32 + B id, with its number of links in the text."""
    fields = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    @F.arrow_udf(ALIGNED)
    def run(batch: pa.Array) -> pa.Array:
        parts = []
        for part in chunks(batch, CHUNK_BYTES):
            got = _aligner(a, b)(part)
            parts.append(pa.StructArray.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(got.values(), fields)], fields=list(fields)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(fields)))

    return materialize(texts.select(text_id(F.col("text")).alias("tid"), "n_docs", run("text").alias("got"))
                       .select("tid", "n_docs", "got.*"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold the pair linked, and whether no
    other pair of its A id has more. Stored."""
    counts = materialize(aligned.select("n_docs", F.explode("pairs").alias("pair"))
                         .groupBy("pair").agg(F.sum("n_docs").alias("docs")))
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("top"))
    return materialize(counts.withColumn("a", a).join(top, "a")
                       .select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))


def frequent_share(counts: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> int:
    """Least power of two so that at most ``limit`` pairs have that many documents
    (at most 64 numbers come to the driver)."""
    size = dict(counts.groupBy(F.floor(F.log2("docs")).cast("int").alias("k")).count().collect())
    k, held = max(size, default=0) + 1, 0
    while k > 0 and held + size.get(k - 1, 0) <= limit:
        k -= 1
        held += size.get(k, 0)
    return 1 << k


def measure(aligned: DataFrame, counts: DataFrame, max_broadcast: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """(tid, n_best, count_sum) of each distinct text that has links."""
    asked = aligned.select("tid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("tid", "p.pairs", "p.times")
    asked = asked.withColumnRenamed("pairs", "pair")
    enough = frequent_share(counts, max_broadcast)

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("tid").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                       F.sum(F.col("times") * F.col("docs")).alias("count_sum"))

    got = totals(asked.join(F.broadcast(counts.filter(F.col("docs") >= enough)), "pair"))
    if enough > 1:
        rare = asked.join(F.broadcast(counts.filter(F.col("docs") >= enough).select("pair")), "pair", "left_anti")
        got = got.unionByName(totals(rare.join(counts.filter(F.col("docs") < enough), "pair"))) \
                 .groupBy("tid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return got


def align(docs: DataFrame, a: bytes, b: bytes, text: str = "text", max_broadcast: int = MAX_BROADCAST_ROWS,
          drop_text: bool = False) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256. ``a`` is the content of a byte-level tokenizer's JSON file,
    ``b`` that of a sentencepiece model."""
    aligned = align_texts(distinct_texts(docs, text), a, b)
    counts = pair_counts(aligned)
    per_text = (aligned.select("tid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                .join(measure(aligned, counts, max_broadcast), "tid", "left"))
    d = docs.select(packed(docs, (*MEASURES, text) if drop_text else MEASURES), text_id(text_of(text)).alias("tid"))
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in MEASURES[:-1]]
    return d.join(per_text, "tid", "left").select("_doc.*", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
