import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costlake.llm import suffix_dedup as S
from costlake.llm.suffix_array import find_rows, kasai, ranked_suffixes, suffix_array
from tests.conftest import SF_SMALL


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200) | st.text(alphabet="ab", max_size=200).map(str.encode))
def test_suffix_array_and_common_prefixes(data):
    d = np.frombuffer(data, np.uint8)
    sa = suffix_array(d)
    want = sorted(range(len(data)), key=lambda i: data[i:])
    assert list(sa) == want

    def common(a, b):
        n = 0
        while a + n < len(data) and b + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        return n

    assert list(kasai(d, sa)) == [0] * bool(want) + [common(a, b) for a, b in zip(want, want[1:])]
    assert list(kasai(d, sa, 5)) == [0] * bool(want) + [min(5, common(a, b)) for a, b in zip(want, want[1:])]
    some, rank = ranked_suffixes(d, 12)
    assert list(kasai(d, some, 10, rank)) == [0] * bool(want) + [min(10, common(a, b)) for a, b in zip(some, some[1:])]
    assert [data[i:i + 12] for i in some] == sorted(data[i:i + 12] for i in range(len(data)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=30).map(str.encode), min_size=1, max_size=12), st.integers(1, 20))
def test_windows_alone_are_ordered_and_compared(segments, length):
    """Ranks by need, and common prefixes of the windows only."""
    data = b"".join(segments)
    d, size = np.frombuffer(data, np.uint8), np.array([len(s) for s in segments])
    left = np.repeat(np.cumsum(size), size) - np.arange(len(d))
    sa, rank = ranked_suffixes(d, length, np.minimum(left, length))
    assert sorted(sa) == list(range(len(data)))
    some = sa[left[sa] >= length]
    windows = [data[i:i + length] for i in some]
    assert windows == sorted(windows)
    same = [0] * bool(windows) + [int(a == b) for a, b in zip(windows, windows[1:])]
    assert list((kasai(d, some, length, rank) >= length).astype(int)) == same


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=11, max_size=11), max_size=40), st.lists(st.binary(min_size=11, max_size=11), max_size=20))
def test_find_rows(table, rows):
    table = sorted(set(table))
    rows = rows + table[::3]
    pack = lambda x: np.frombuffer(b"".join(x), np.uint8).reshape(len(x), 11)
    assert list(find_rows(pack(table), pack(rows))) == [table.index(r) if r in table else -1 for r in rows]


@pytest.mark.parametrize("shard_bytes", [30, 100, 10**6])
def test_merging_shards(shard_bytes):
    rng = random.Random(shard_bytes)
    segs = ["".join(rng.choice("ab") for _ in range(rng.randint(3, 30))).encode() for _ in range(40)]
    low = np.array([rng.randint(0, 100) for _ in segs])
    sizes = np.array([len(s) for s in segs])
    got = S.smallest_holder(np.frombuffer(b"".join(segs), np.uint8), sizes, low, 5, shard_bytes)
    best, want = {}, []
    for s, w in zip(segs, low):
        for i in range(len(s) - 4):
            best[s[i:i + 5]] = min(best.get(s[i:i + 5], 10**9), w)
    for s in segs:
        want += [best[s[i:i + 5]] for i in range(len(s) - 4)]
    assert list(got) == want


def brute(docs):
    docs = [(S.NO_ID if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, b in docs:
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(d), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(S.NO_ID if r["doc_id"] is None else r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"],
                   r["kept_sha256"]) for r in df.collect())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    assert result(S.dedup_substrings(docs, drop_text=True)) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_edge_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_DOCS", hot)
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, line = word(180), word(49)
    rows = [(10, None), (11, ""), (12, "short"), (13, "a" * 49), (14, "a" * 200), (9, "a" * 90), (3, passage), (4, passage),
            (4, passage), (None, passage), (None, word(40) + passage), (20, line + "x"), (21, line + "y"),
            (22, word(30000) + passage), (23, "\0" * 120), (24, "\0" * 60)]
    rows += [(100 + i, word(rng.randint(0, 60)) + passage[rng.randint(0, 40):] + word(20)) for i in range(30)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(3)
    out = S.dedup_substrings(df, stored=False, rows_per_block=7)
    assert result(out) == brute(rows)
    for r in out.collect():
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"] and r["part"] == 1
    assert S.dedup_substrings(df.limit(0), stored=False).count() == 0


def test_rows_between_blocks_and_parts_follow_the_bytes(spark, monkeypatch):
    """Many short documents are one block, so the answers are a row per part and no more."""
    told, keep = [], S.materialize

    def counted(df):
        out = keep(df)
        told.append(out.count())
        return out

    monkeypatch.setattr(S, "materialize", counted)
    rows = [(i, f"document {i % 2000} " * 4 + "of a few lines that others have as well") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert result(S.dedup_substrings(df)) == brute(rows)
    assert len(told) == 2 and max(told) <= 16


def test_blocks_hold_fewer_of_long_texts():
    assert S.block_rows(0, 0.0, 0.0) == S.BLOCK_ROWS == S.block_rows(10**6, 1e7, 1e8)
    assert S.block_rows(10**6, 1e10, 1e14) == S.BLOCK_BYTES // 10_000
    few_long = S.block_rows(10**6, 1e9 + 1e4 * 1e5, 1e15 + 1e4 * 1e10)     # 1 % of 100 KB: they may stand together
    assert few_long < 10**6 * S.BLOCK_BYTES / 2e9 and few_long * 100_000 < 2 * S.BLOCK_MOST
    assert S.block_rows(3, 3e9, 3e18) == 1


@pytest.mark.parametrize("clash", [False, True])
def test_suffix_arrays_hold_windows_that_may_repeat(monkeypatch, clash):
    rng = random.Random(3)
    word = lambda n: bytes(rng.randrange(256) for _ in range(n))
    passage = word(70)
    segs = [word(100) for _ in range(200)] + [word(60) + passage, passage[:60] + word(60), b"a" * 90]
    low = np.array([rng.randint(0, 100) for _ in segs])
    sorted_bytes, sort = [], S.ranked_suffixes
    monkeypatch.setattr(S, "ranked_suffixes", lambda d, *more: sorted_bytes.append(len(d)) or sort(d, *more))
    if clash:       # a hash that tells nothing leaves all windows to compare
        monkeypatch.setattr(S, "window_hashes", lambda d, sizes, length: np.zeros((sizes - length + 1).sum(), np.uint64))
    sizes = np.array([len(s) for s in segs])
    got = S.smallest_holder(np.frombuffer(b"".join(segs), np.uint8), sizes, low)
    best = {}
    for s, w in zip(segs, low):
        for i in range(len(s) - 49):
            best[s[i:i + 50]] = min(best.get(s[i:i + 50], 10**9), w)
    assert list(got) == [best[s[i:i + 50]] for s in segs for i in range(len(s) - 49)]
    assert (sum(sorted_bytes) == sizes.sum()) if clash else (sum(sorted_bytes) <= 60 + 60 + 90)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40).map(str.encode), min_size=1, max_size=12), st.integers(1, 20))
def test_equal_windows_are_never_lost(segments, length):
    sizes = np.array([len(s) for s in segments])
    h = S.window_hashes(np.frombuffer(b"".join(segments), np.uint8), sizes, length)
    windows = [s[i:i + length] for s in segments for i in range(len(s) - length + 1)]
    assert len(h) == len(windows) and len(set(zip(h.tolist(), windows))) == len(set(windows))
    assert all(told or windows.count(w) == 1 for told, w in zip(S.repeated(h), windows))
