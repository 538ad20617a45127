from collections import Counter

import corpus_pipeline as P
from costlake.llm import decontam, mixing, quality_rules
from costlake.session import materialize
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_rules_decontam import hits


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    def ids(df):
        assert df.columns == docs.columns
        return {r["doc_id"] for r in df.collect()}

    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.host_quality(docs).collect()}
    one = materialize(P.quality(spark, docs, SF_SMALL))
    assert ids(one) == {d for d, k in verdict.items() if k}
    two = materialize(P.near_dedup(spark, one, SF_SMALL))
    assert ids(two) == {c for _, c in brute.simhash_components([(d, text[d]) for d in ids(one)]).values()}
    three = materialize(P.decontaminate(spark, two, SF_SMALL))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert ids(three) == {k[0] for k in hits([(d, text[d]) for d in ids(two)], items) if not k[-1]}
    four = materialize(P.mix_sources(spark, three, SF_SMALL))
    assert ids(four) == {r["doc_id"] for r in mixing.mix(three).collect() if r["selected"]}
    five = P.shard(spark, four, SF_SMALL).collect()
    n = Counter(r["shard"] for r in five)
    assert {r["doc_id"] for r in five} == ids(four) and max(n.values()) - min(n.values()) <= 1
    assert [name for name, _ in P.STAGES][0] == "quality" and len(P.STAGES) == 5
    assert decontam.WINDOW == 13


def test_run_returns_the_last_stage(spark):
    out = P.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert out.count() > 0


def test_every_stage_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL) if docs.columns == P.COLUMNS else docs
    assert docs.count() == 0


def test_stages_take_odd_rows_and_columns(spark):
    """NULLs in every column, empty and very long texts, repeated rows, clashing names."""
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words, "en", "s", 5), (1, words, "en", "s", 5), (2, None, None, None, None), (3, "", "", "", 0), (None, words + " x y z", None, None, None),
            (None, None, None, None, None), (4, " ".join(f"long{i}" for i in range(60_000)), "en", "s", 1), (5, "short", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "7 AS n_words", "8 AS shard", "9 AS slot", "10 AS size", "'t' AS topic", "11 AS fp")
    extra = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF_SMALL))
        assert sorted(docs.columns) == sorted(extra), name
        if name == "near_dedup":
            assert sorted(str(r["doc_id"]) for r in docs.collect()) == ["1", "4", "None"]
    last = P.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {"text", "topic", "fp", "n_words"} <= set(last.columns) and last.count() == docs.count()


def test_a_stage_frees_what_the_one_before_left(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lazy = P.quality(spark, docs, SF_SMALL)
    held = list(P._left)
    two = P.near_dedup(spark, lazy, SF_SMALL)            # not written: what it reads stays
    assert set(P._left) >= set(held)
    n = two.count()
    one = materialize(P.quality(spark, docs, SF_SMALL))
    held = list(P._left)
    assert P.near_dedup(spark, one, SF_SMALL).count() == n and not set(held) & set(P._left)
