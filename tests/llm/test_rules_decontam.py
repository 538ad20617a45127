import hashlib
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from costlake.llm import decontam, quality_rules
from tests.conftest import SF_SMALL
from tests.llm.brute import LOWER, SPACE

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def hits(docs, items, n=13):
    wins = defaultdict(set)
    for i, t in items:
        w = plain(t)
        for s in range(max(1, len(w) - n + 1)) if w else ():
            wins[tuple(w[s:s + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, covered, ids = plain(t), set(), set()
        for size in {len(x) for x in wins}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in wins:
                    covered |= set(range(s, s + size))
                    ids |= wins[tuple(w[s:s + size])]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(covered), len(ids), sha, len(covered) > 0 and 20 * len(covered) >= len(w)))
    return Counter(out)


COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return decontam.decontaminate(d, i)


def test_decontamination_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (2, "The cat"), (3, None), (4, "  "), (5, "cat"), (None, "dog"), (2, "The cat"), (6, "x x x")]
    docs = [(1, long), (2, "a " + long[:60]), (3, None), (4, ""), (5, "THE  CAT, the cat"), (6, "dog"), (None, "cat dog"),
            (7, "x " * 5000), (8, "z " * 20000 + long), (8, "z " * 20000 + long), (9, "É cat-é")]
    got = Counter(tuple(r[c] for c in COLS) for r in run(spark, docs, items).collect())
    assert got == hits(docs, items)
    assert run(spark, [], items).count() == 0
    assert {r["n_items"] for r in run(spark, docs, []).collect()} == {0}


def test_proximity_matches_are_reported(spark):
    words = [f"w{i}" for i in range(13)]
    changed = words[:6] + ["other"] + words[6:]
    out = run(spark, [(1, " ".join(words)), (2, " ".join(changed)), (3, "w1 w2")], [(1, " ".join(words))]).collect()
    near = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in out}
    assert near[1] == (13, 0) and near[3] == (0, 0) and near[2][0] == 0


def test_a_near_copy_without_its_rarest_words_is_found(spark):
    words = [f"w{i}" for i in range(13)]
    common = " ".join(words[2:]) + " "

    def near(*changed):
        return " ".join("other" if i in changed else w for i, w in enumerate(words))

    docs = [(1, near(0)), (2, "a b c " + near(0, 1) + " d e"), (3, near(0, 1, 2)), (4, near()), (5, near(4, 9)),
            (6, near()[3:]), (7, common * 3), (8, near() + " " + "z " * 70 + near(0)), (9, "z " * 60 + near(12))]
    out = run(spark, docs + [(10, "w0 w5 w1")], [(1, near())]).collect()
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in out}
    assert got == {1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (13, 0), 5: (0, 1), 6: (0, 1), 7: (0, 1), 8: (13, 1), 9: (0, 1),
                   10: (0, 0)}
    # the corpus lacks the replaced word altogether
    out = run(spark, [(1, near(6)), (2, near(6, 7, 8))], [(1, near())]).collect()
    assert {r["doc_id"]: r["n_near"] for r in out} == {1: 1, 2: 0}


def near_by_hand(text, items, n=13, slop=2):
    """Distinct windows with a near match that is no exact one of theirs."""
    w, found = plain(text), set()
    wins = {tuple(t[s:s + n]) for t in map(plain, items) if t for s in range(max(1, len(t) - n + 1))}
    for win in wins:
        k = len(win)
        near, exact = [], []
        for s in range(-k - slop, len(w) + slop + 1):
            placed = sum(any(0 <= s + i + d < len(w) and w[s + i + d] == x for d in range(-slop, slop + 1)) for i, x in enumerate(win))
            if 10 * placed >= 8 * k:
                near.append(s)
            if s >= 0 and tuple(w[s:s + k]) == win:
                exact.append(s)
        if any(all(abs(s - e) > slop for e in exact) for s in near):
            found.add(win)
    return len(found)


@settings(max_examples=5, deadline=None)
@given(seed=st.integers(0, 10**6))
def test_near_matches_by_hand(spark, seed):
    rng = random.Random(seed)
    items = [" ".join(rng.choice("abcdefgh") for _ in range(k)) for k in (1, 2, 3, 5, 6, 13, 16, 20)] + ["x x x x x x", "a b a b a b a b a b a b a b"]
    docs = [(0, None), (1, "")]
    for i in range(2, 30):
        words = rng.choice(items).split()
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randint(0, 2)] = rng.choices("abcdefghz", k=rng.randint(0, 2))
        docs.append((i, " ".join(rng.choices("qrs", k=rng.randint(0, 40)) + words + rng.choices("qa", k=3))))
    got = {r["doc_id"]: r["n_near"] for r in run(spark, docs, list(enumerate(items))).collect()}
    assert got == {d: near_by_hand(t, items) for d, t in docs}


def test_order_and_places_count(spark):
    words = [f"w{i}" for i in range(13)]
    swapped = words[:3] + [words[4], words[3]] + words[5:]
    docs = [(1, " ".join(reversed(words))), (2, " ".join(swapped)), (3, " z z z ".join(words))]
    got = {r["doc_id"]: r["n_near"] for r in run(spark, docs, [(1, " ".join(words))]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_clashing_columns_and_shuffled_joins(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "a " + long + " b", 5, "x"), (1, "a " + long + " b", 5, "x"), (2, long.replace("w9", "zz"), 6, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, doc int, words string").selectExpr(
        "*", "7 AS n_hit", "8 AS at", "9 AS id", "10 AS spans", "11 AS term")
    items = spark.createDataFrame([(1, long), (2, long)], "item_id long, text string")
    one = decontam.decontaminate(d, items)
    assert one.columns == ["doc_id", "text", "doc", "words", "at", "id", "spans", "term", "n_words", "n_hit", "n_items",
                           "items_sha256", "n_near", "contaminated"]
    rows = sorted(map(str, one.collect()))
    assert [(r["doc_id"], r["n_hit"], r["n_items"], r["at"]) for r in one.collect()] == [(1, 30, 2, 8), (1, 30, 2, 8), (2, 20, 2, 8)]
    monkeypatch.setattr(decontam, "MAX_BROADCAST_ROWS", 0)
    assert sorted(map(str, decontam.decontaminate(d, items).collect())) == rows


def rules(docs):
    out = []
    for d, _, t in docs:
        t = t or ""
        words = SPACE.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACE.search(line):
                dup += line in seen
                seen.add(line)
        wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        times = Counter(wins)
        rep = {p for i, w in enumerate(wins) if times[w] > 1 for p in range(i, i + 8)}
        out.append((d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep),
                    len(words) < 20 or 100 * len(rep) > 30 * len(words)))
    return Counter(out)


MEASURED = ["doc_id", *quality_rules.MEASURES, "base_failed"]


def test_rules_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "text")
    got = Counter(tuple(r[c] for c in MEASURED) for r in quality_rules.base_rules(df).collect())
    assert got == rules([tuple(r) for r in df.collect()])


@settings(max_examples=8, deadline=None)
@given(docs=st.lists(st.text(alphabet="ab \n\x0b#é", max_size=120), max_size=12))
def test_rules_on_odd_texts(spark, docs):
    rows = [(i, "s", t) for i, t in enumerate(docs)] + [(-1, None, None), (-2, "s", "a b " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = Counter(tuple(r[c] for c in MEASURED) for r in quality_rules.base_rules(df).collect())
    assert got == rules(rows)


def test_a_bad_host_takes_its_documents_with_it(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, "bad", "short") for i in range(95)] + [(100 + i, "bad", good) for i in range(2)]
    rows += [(200 + i, "good", good) for i in range(50)] + [(300, "new", "short"), (301, None, good), (301, None, good)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "5 AS host", "1 AS kept")
    out = {r["doc_id"]: r for r in quality_rules.host_quality(df).collect()}
    assert not out[100]["kept"] and out[200]["kept"] and out[301]["kept"] and not out[300]["kept"]
    assert out[300]["host_rate"] < 1 and out[200]["host"] == 5
    assert quality_rules.host_quality(df.limit(0)).count() == 0


def test_a_host_of_repeated_lines_is_rejected(spark):
    def text(i):
        return "\n".join(f"read more about it\nstory{k} {i} number{k} told{k}" for k in range(12))

    rows = [(i, "echo", text(i)) for i in range(60)]
    rows += [(100 + i, "good", " ".join(f"word{k}" for k in range(40))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r["doc_id"]: r for r in quality_rules.host_quality(df).collect()}
    assert not out[0]["base_failed"] and out[0]["n_dup_lines"] == 11
    assert {r["kept"] for i, r in out.items() if i < 100} == {False} and out[100]["kept"]
    assert quality_rules.LINES not in out[0].asDict()
