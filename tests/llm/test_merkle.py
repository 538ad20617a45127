"""op12 against a tree that is built and climbed one node at a time."""
import hashlib
import zlib

import pytest

from costlake.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(s):
    return s if s is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def climb(nodes):
    """(last node, the steps of every node): steps are (before, after) texts."""
    steps, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for s, p in zip(steps, place):
            run = runs[p // 16]
            s.append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        nodes, place = [digest(*r) for r in runs], [p // 16 for p in place]
    return nodes[0], steps


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the sorted results."""
    by = {}
    for r in rows:
        leaf = digest(*map(enc, r))
        forged = digest(*map(enc, (*r[:4], lower(r[4]))))
        by.setdefault(r[1], []).append((r[0], leaf, forged))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        by[s].sort(key=lambda x: (-(1 << 63) if x[0] is None else x[0], x[1]))
        trees.append(climb([x[1] for x in by[s]]))
    root, over = climb([t[0] for t in trees])
    out = []
    for s, (subroot, steps), up in zip(names, trees, over):
        for (i, leaf, forged), mine in zip(by[s], steps):
            path = mine + up
            bad = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
            node = forged if bad else leaf
            for pre, post in path:
                node = digest(pre, node, post)
            out.append((i, leaf, subroot, root, digest("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def run(spark, rows, extra=False):
    d = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    if extra:
        d = d.selectExpr("*", "1 AS slot", "'x' AS leaf", "2 AS grp", "3 AS kids")
    out = merkle.manifest(d, tampered=merkle.every_fifth())
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.drop("proof").collect()), key=repr)


def row(i, source, text="Some Text"):
    return (i, source, "en", len(text) if text else None, text)


CASES = {
    "one leaf": [row(7, "a")],
    "lone sources": [row(i, f"s{i}") for i in range(18)],
    "runs of one": [row(i, "a") for i in range(17)] + [row(i, "b") for i in range(40, 56)],
    "three levels and odd ids": [row(i * 7919 - 900_000, "big", f"Doc {i}") for i in range(300)] + [row(-5, "ä"), row(3, None)],
    "far ids": [row(i, "a") for i in (-(1 << 63), (1 << 63) - 1, 0, 63, 64, -1, -64, 32767, 32768)],
    "nulls": [(None, None, None, None, None), (None, None, None, None, None), (1, None, None, 4, None), (2, "x", None, None, "ABC")],
    "repeated rows": [row(5, "a")] * 40 + [row(5, "a", "other")] * 3 + [row(6, "a"), row(70, "a"), row(4, "a")] + [row(5, "b")],
    "long and empty": [row(1, "a", ""), row(2, "a", "Long " * 200_000), row(3, "", "x")],
}


@pytest.mark.parametrize("name", CASES)
def test_manifest(spark, name):
    assert run(spark, CASES[name], extra=True) == brute(CASES[name])


def test_the_index_may_be_shuffled(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MAX_BROADCAST_ROWS", 0)
    rows = CASES["three levels and odd ids"] + CASES["repeated rows"]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_untampered_rows_verify(spark):
    rows = [row(i, "a", "lower only") for i in range(50)] + [row(99 + i, "b", "UPPER") for i in range(50)]
    for i, leaf, *_, verified in run(spark, rows):
        assert verified == (i < 99 or zlib.crc32(str(i).encode()) % 5 != 0)


def test_rows_of_an_index_count_its_ids(spark):
    d = spark.createDataFrame([(i, "a") for i in range(100_000, 100_300)] + [(64, "a"), (64, "a")], "doc_id bigint, source string")
    index, facts = merkle.build_index(d)
    rows = sorted((r["word"], bin(r["bits"] & (1 << 64) - 1).count("1"), r["before"]) for r in index.collect())
    assert facts == {"words": len(rows), "spare": 1, "largest": 302}
    assert rows[0] == (1, 1, 0) and [r[2] for r in rows[1:]] == [2 + sum(x[1] for x in rows[1:k]) for k in range(1, len(rows))]
