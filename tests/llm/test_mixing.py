import itertools
from collections import defaultdict

import numpy as np

from costlake.llm import mixing
from tests.conftest import SF_SMALL


def reachable(asked, have, budget):
    """Targets in proportion to ``asked``, none above what there is: the common
    factor is found by halving."""
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(have[k], asked[k] * mid) for k in asked) < budget else (lo, mid)
    return {k: min(have[k], asked[k] * hi) for k in asked}


def rake_by_hand(cells, asked, budget, rounds=3000):
    """{cell: weight}, one cell and one marginal at a time, by floats."""
    total = sum(cells.values())
    w = {c: t * budget / total for c, t in cells.items()}
    for _ in range(rounds):
        for d, shares in enumerate(asked):
            have = {}
            for c, t in cells.items():
                have[c[d]] = have.get(c[d], 0) + t
            wants = reachable(shares, have, budget)
            for v, want in wants.items():
                now = sum(x for c, x in w.items() if c[d] == v)
                for c in w:
                    if c[d] == v and now:
                        w[c] = min(w[c] * want / now, cells[c])
    return w


def test_rake_equals_one_by_hand():
    cells = {(a, b): t for (a, b), t in zip(itertools.product("xyz", "mn"), [100.0, 1, 1, 60, 7, 30])}
    asked = [{"x": .4, "y": .3, "z": .3}, {"m": .5, "n": .5}]
    keys = list(cells)
    codes = [np.array(["xyz".index(k[0]) for k in keys]), np.array(["mn".index(k[1]) for k in keys])]
    shares = [np.array(list(s.values())) for s in asked]
    for budget in (20.0, 60.0, 90.0):
        w = mixing.rake_arrays(np.array(list(cells.values())), codes, shares, budget, rounds=3000)
        hand = rake_by_hand(cells, asked, budget)
        assert np.allclose(w, list(hand.values()), rtol=1e-4, atol=1e-6)


def test_targets_beyond_the_tokens_are_levelled():
    """One category has nearly all tokens: the others give theirs, it gives the rest."""
    tokens, share = np.array([100.0, 1, 1, 1]), np.full(4, .25)
    assert mixing.level(share, tokens, 90.0).tolist() == [87, 1, 1, 1]
    w = mixing.rake_arrays(tokens, [np.arange(4)], [share], 90.0)
    assert np.allclose(w, [87, 1, 1, 1]) and mixing.gaps(w, tokens, [np.arange(4)], [share], 90.0).max() < 1e-6
    assert mixing.level(np.zeros(0), np.zeros(0), 1.0).tolist() == []


def test_a_gap_that_no_sample_closes_is_told(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TRIES", 2)
    """Source and language say the same of the documents, but the targets do not agree."""
    d = spark.createDataFrame([(i, "a b", "s" if i < 5 else "t", "u" if i < 5 else "v") for i in range(10)],
                              "doc_id long, text string, source string, lang string")
    share = lambda dim, **of: spark.createDataFrame(list(of.items()), "value string, share double")
    targets = {"source": share("source", s=.9, t=.1), "lang": share("lang", u=.1, v=.9), "topic": share("topic", prose=1.0)}
    for max_cells in (0, 100):
        out = mixing.mix(d, targets, max_cells=max_cells, rounds=2).collect()
        assert len(out) == 10 and min(r["residual"] for r in out) > 0.5


def test_sample_meets_the_marginals(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["probability"] <= 1 for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    assert all(r["n_tokens"] == len((r["text"] or "").split()) or not (r["text"] or "").isascii() for r in rows)
    for dim in mixing.DIMS:
        have, expect = defaultdict(float), defaultdict(float)
        for r in rows:
            have[r[dim]] += r["n_tokens"]
            expect[r[dim]] += r["n_tokens"] * r["probability"]
        asked = {k: v ** mixing.FLATTEN for k, v in have.items()}
        for k, want in reachable(asked, have, sum(expect.values())).items():
            assert abs(expect[k] - want) <= 1e-3 * max(want, 1)
    assert max(r["residual"] for r in rows) <= mixing.RESIDUAL
    assert sum(expect.values()) > 0.5 * total
    assert abs(sum(r["selected"] for r in rows) - sum(r["probability"] for r in rows)) < 4 * len(rows) ** 0.5
    again = mixing.mix(docs.repartition(7)).collect()
    assert {(r["doc_id"], r["selected"]) for r in again} == {(r["doc_id"], r["selected"]) for r in rows}


def test_both_ways_to_rake_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TRIES", 1)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("source in ('src0', 'src1')")
    one = {r["doc_id"]: r["probability"] for r in mixing.mix(docs, rounds=3).collect()}
    two = {r["doc_id"]: r["probability"] for r in mixing.mix(docs, max_cells=0, rounds=3).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_rake_hits_given_targets():
    tokens = np.full(9, 100.0)
    codes = [np.repeat([0, 1, 2], 3), np.tile([0, 1, 2], 3)]
    shares = [np.array([.5, .3, .2]), np.array([.2, .2, .6])]
    w = mixing.rake_arrays(tokens, codes, shares, 300.0)
    assert np.allclose(np.bincount(codes[0], w) / 300, shares[0]) and np.allclose(np.bincount(codes[1], w) / 300, shares[1])
    assert (w <= 100).all()


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, None, None, "a"), (2, "", "s", "en", "b"), (3, "a b", "s", None, "c"),
                                (3, "a b", "s", None, "c"), (None, "x " * 9000, None, "en", "d")],
                               "doc_id long, text string, source string, lang string, weight string")
    out = mixing.mix(df).collect()
    assert len(out) == 5 and len({(r["probability"], r["selected"]) for r in out if r["doc_id"] == 3}) == 1
    assert mixing.mix(df.limit(0)).count() == 0
