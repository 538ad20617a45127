import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costlake.llm import licenses, ngram_lm
from costlake.llm.blocks import planes, unplanes
from tests.llm.brute import SPACE


def brute_scores(texts, order):
    """Every document by the counts of the others, one word and context at a time."""
    words = [SPACE.findall(t or "") for t in texts]
    each = [Counter(tuple(d[i:i + k]) for k in range(1, order + 1) for i in range(len(d) - k + 1)) for d in words]
    every, n, out = sum(each, Counter()), sum(map(len, words)), []
    for d, own in zip(words, each):
        s = back = 0
        for i, w in enumerate(d):
            longest = min(i + 1, order)
            for k in range(longest, 0, -1):
                gram = tuple(d[i - k + 1:i + 1])
                c = every[gram] - own[gram]
                if c or k == 1:
                    under = every[gram[:-1]] - own[gram[:-1]] if k > 1 else max(n - len(d), 1)
                    s += math.log10(0.4 ** (longest - k) * max(c, 1) / under)
                    back += k < longest
                    break
        out.append((len(d), back, round(s, 6) + 0.0))
    return out


@pytest.mark.parametrize("per_block,order", [(1, 2), (2, 3), (100, 2), (100, 4), (3, 1)])
def test_scores_equal_brute_force(spark, per_block, order):
    texts = [None, "", " \n", "a", "a b a b", "a b c", "é\x0bb ü", "x" * 5000, "y z " * 8000, "a b a b", "a b a b", "a b c d a b c"]
    rows = [(i if i < 9 else 9, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    out = ngram_lm.lm_scores(df, stored=False, rows_per_block=per_block, order=order).collect()
    got = sorted((r["doc_id"], r["text"] or "", (r["n_words"], r["n_backoff"], round(r["lm_score"], 6) + 0.0)) for r in out)
    want = sorted((i if i < 9 else 9, t or "", s) for i, (t, s) in enumerate(zip(texts, brute_scores(texts, order))))
    assert got == want and {r["block"] for r in out} == {"kept"}
    assert ngram_lm.lm_scores(df.limit(0), stored=False).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\x0c", max_size=30), max_size=6), st.integers(0, 3))
def test_word_hashes_follow_the_words(texts, skip):
    h, counts = ngram_lm.word_hashes(pa.array(["zz"] * skip + texts)[skip:])
    words = [SPACE.findall(t) for t in texts]
    assert list(counts) == [len(w) for w in words]
    flat = [w for d in words for w in d]
    by = {}
    for w, x in zip(flat, h):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    two, at = ngram_lm.ngrams(h, counts, 2)[1]
    assert len(two) == sum(max(0, len(d) - 1) for d in words) and len(set(two)) == len(
        {p for d in words for p in zip(d, d[1:])})


def test_answers_of_another_block_are_refused():
    asked = pa.record_batch({"block": [5], "text": ["a b c"]})
    told = [r for b in ngram_lm._answer(ngram_lm._ask(16)(iter([asked]))) for r in b.to_pylist()]
    totals = np.concatenate([unplanes(r["totals"], np.uint64) for r in told])
    checks = [r.get("check") for r in told]
    assert ngram_lm.score_block(pa.array(["a b c"]), totals, 3, checks)[0].tolist() == [3]
    with pytest.raises(ValueError):
        ngram_lm.score_block(pa.array(["x y z"]), totals, 3, checks)


def test_planes_round_trip():
    x = np.array([0, 1, 2**63, 5], np.uint64)
    assert (unplanes(planes(x), np.uint64) == x).all()


MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_headers_and_inheritance(spark):
    rows = [("a/LICENSE", MIT), ("a/b/x.py", "no notice"), ("a/b/COPYING", GPL), ("a/b/c/d/y.py", None), ("a/z.py", ""),
            ("a/b/own.py", "# Licensed under the Apache License,\n# Version 2.0\nimport os"), ("top.py", "plain"),
            (None, "plain"), (None, MIT), ("a/b/x.py", "no notice"), ("a/notes.txt", "w " * 30000 + "\n" + GPL),
            ("ab/q.py", "the licence question is open and nobody knows"), ("LICENSE.txt/deep.py", "x")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "path string, text string, dir string")
    out = licenses.scan_licenses(df).collect()
    got = {(r["path"], (r["text"] or "")[:9]): (r["license"], r["license_from"], r["license_dir"]) for r in out}
    assert len(out) == len(rows) and {r["dir"] for r in out} == {"mine"}
    assert got["a/LICENSE", MIT[:9]] == ("MIT", "file", None)
    assert got["a/b/x.py", "no notice"] == ("GPL-3.0", "inherited", "a/b")
    assert got["a/b/c/d/y.py", ""] == ("GPL-3.0", "inherited", "a/b")
    assert got["a/z.py", ""] == ("MIT", "inherited", "a")
    assert got["a/b/own.py", "# License"][:2] == ("Apache-2.0", "file")
    assert got["a/notes.txt", "w w w w w"][:2] == ("GPL-3.0", "file")
    assert got["top.py", "plain"] == got[None, "plain"] == got["ab/q.py", "the licen"] == (None, None, None)
    assert got[None, MIT[:9]] == ("MIT", "file", None)
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_a_root_licence_covers_everything(spark):
    df = spark.createDataFrame([("LICENSE", MIT), ("x/y/z.py", "plain")], "path string, text string")
    got = {r["path"]: (r["license"], r["license_dir"]) for r in licenses.scan_licenses(df).collect()}
    assert got == {"LICENSE": ("MIT", None), "x/y/z.py": ("MIT", "")}


def body_of(name):
    folder = os.path.join(os.path.dirname(licenses.__file__), "license_texts")
    with open(os.path.join(folder, f"{name}.txt")) as f:
        return f.read()


def test_bodies_and_long_headers(spark):
    def commented(text, mark):
        return "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n"))

    about = [f"this module keeps part {i} of the accounts and of their totals" for i in range(20)]
    hint = "Copyright (c) 2020, The Authors. All rights reserved.\n\n"
    rows = [("LICENSE", "Dedicated to the public domain under CC0 1.0 Universal"),
            ("a/LICENSE", body_of("MIT").replace("AUTHORS", "OWNERS")), ("a/x.py", "plain"),
            ("b/COPYING", hint + body_of("BSD-2-Clause")), ("b/c/LICENSE.md", hint + body_of("BSD-3-Clause")),
            ("d/LICENSE", body_of("GPL-3.0")), ("d/x.py", None), ("e/LICENCE", body_of("Apache-2.0") + "\nCopyright 2020 Me\n"),
            ("f/x.py", commented(hint + body_of("ISC"), "#") + "\nimport os\n"),
            ("f/x.c", "/*\n" + commented(hint + body_of("MIT"), " *") + "\n */\nint x;"),
            ("f/y.py", '"""' + hint + body_of("BSD-3-Clause") + '"""\nimport os'),
            ("f/long.py", commented("\n".join([*about[:9], "Released under the MIT License", *about[9:]]), "#")),
            ("f/wrapped.py", commented("\n".join([*about, hint + "It is kept here. Licensed under the Apache",
                                                  "License, Version 2.0. See there."]), "#")),
            ("f/plain.py", commented("\n".join(about), "#"))]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r["path"]: (r["license"], r["license_from"], r["license_dir"]) for r in licenses.scan_licenses(df).collect()}
    names = {"LICENSE": "CC0-1.0", "a/LICENSE": "MIT", "b/COPYING": "BSD-2-Clause", "b/c/LICENSE.md": "BSD-3-Clause",
             "d/LICENSE": "GPL-3.0", "e/LICENCE": "Apache-2.0", "f/x.py": "ISC", "f/x.c": "MIT", "f/y.py": "BSD-3-Clause",
             "f/long.py": "MIT", "f/wrapped.py": "Apache-2.0"}
    want = {path: (name, "file", None) for path, name in names.items()}
    want |= {"a/x.py": ("MIT", "inherited", "a"), "d/x.py": ("GPL-3.0", "inherited", "d"),
             "f/plain.py": ("CC0-1.0", "inherited", "")}
    assert got == want
