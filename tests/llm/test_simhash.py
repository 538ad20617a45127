import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costlake.llm import simhash
from costlake.llm.components import components
from tests.conftest import SF_SMALL
from tests.llm import brute


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    want = brute.simhash_components([tuple(r) for r in docs.collect()])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == want
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted({c for _, c in want.values()})


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (5, "One"), (6, "one two"), (None, "one"),
            (7, "x " * 20000), (8, "x " * 20000), (8, "x " * 20000)]
    got = simhash.near_duplicates(docs_frame(spark, rows).withColumnRenamed("text", "text"))
    by = {}
    for r in got.collect():
        by.setdefault(r["component_id"], []).append(r["doc_id"])
    assert sorted(by[1]) == [1, 2, 3] and set(by[4]) == {4, 5, None} and by[7] == [7, 8, 8]
    assert simhash.near_duplicates(docs_frame(spark, [])).count() == 0
    assert simhash.keep_one(docs_frame(spark, rows)).count() == 4


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d", "q", 5, "z")], "doc_id long, text string, fingerprint string, fp long, label string")
    out = simhash.near_duplicates(df)
    r = out.first()
    assert r["fp"] == 5 and r["label"] == "z" and r["fingerprint"] != "q" and out.columns.count("fingerprint") == 1


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), min_size=0, max_size=4, unique=True))
def test_every_link_shares_a_chain(a, flips):
    b = a
    for f in flips:
        b ^= 1 << f

    def keys(v):
        out = set()
        for i in range(4):
            r = ((v << 16 * i) | (v >> (64 - 16 * i))) & (2**64 - 1) if i else v
            hi = r >> 32
            out.add((i, hi))
            out |= {(i, hi | 1 << j) for j in range(16) if not hi >> j & 1}
        return out

    signed = np.array([a, b], np.uint64).view(np.int64)
    linked = any(simhash._linked(np.array([i << 32]), signed[:1] ^ signed[1:])[0] for i, _ in keys(a) & keys(b))
    assert linked == (len(flips) <= 3) or len(flips) > 3 and not linked


@pytest.mark.parametrize("n", [3, 40, 300])
def test_forest_connects_what_all_pairs_connect(n):
    rng = np.random.default_rng(n)
    base = int(rng.integers(0, 2**62))
    f = np.unique(np.array([base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 30, (n, 2))], np.int64))
    k = np.zeros(len(f), np.int64)
    a, b = simhash.bucket_edges(k, f)

    def classes(pairs):
        parent = {int(x): int(x) for x in f}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for x, y in pairs:
            parent[find(int(x))] = find(int(y))
        return {frozenset(y for y in parent if find(y) == find(x)) for x in parent}

    every = [(x, y) for i, x in enumerate(f) for y in f[i + 1:] if simhash._linked(k[:1], np.array([x ^ y]))[0]]
    assert classes(zip(a, b)) == classes(every)
    assert n < 17 or len(a) < len(f)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 400))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
