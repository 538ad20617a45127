"""Quality rules with host-level verdicts.

1. ``base_rules`` measures every whole text and applies the document rules.
2. ``host_rates`` aggregates rule failures by host (partial aggregation on the
   map side, so a host with a third of all rows costs one row per task) and
   shrinks each host's failure rate with a beta prior fitted to all hosts by
   the method of moments (empirical Bayes).
3. ``host_quality`` joins the host verdicts back to the documents.

Defined results: a NULL text has no words and fails the base rules; NULL hosts
form one host of their own; repeated rows are judged one by one; an empty
table gives an empty result. Columns are read by name and extra columns pass
through; the measures are added as new columns, which replace columns of the
same name.

Window repeats inside one text are found by 64-bit hashes of the windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.text import packed, space_words, text_of
from costlake.session import materialize

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
SYMBOLS_RE = r"[#*$%&|<>]+"
# A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.8
# Counted host verdicts up to this many are broadcast; more are joined by shuffle.
MAX_BROADCAST_HOSTS = 100_000
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
LINES = "_n_lines"          # working column: lines with a word
ADDED = (*MEASURES, LINES, "base_failed", "host_rate", "kept")


def _long(c: Column) -> Column:
    return c.cast("bigint")


def _repeat_words(sorted_windows: str) -> Column:
    """Words covered by windows that occur twice or more; ``sorted_windows`` is
    the (hash, start) array in hash order, NULL when no hash repeats."""
    s = F.col(sorted_windows)
    pairs = F.filter(
        F.zip_with(s, F.slice(s, F.lit(2), F.size(s) - 1),
                   lambda a, b: F.struct(a.i.alias("a"), b.i.alias("b"), (a.h == b.h).alias("same"))),
        lambda p: p.same)
    starts = F.array_sort(F.array_distinct(F.concat(
        F.transform(pairs, lambda p: p.a), F.transform(pairs, lambda p: p.b))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        starts, zero,
        lambda acc, i: F.struct((i + REPEAT_WINDOW).alias("end"),
                                (acc.n + F.least(F.lit(REPEAT_WINDOW), i + REPEAT_WINDOW - acc.end)).alias("n")),
        lambda acc: acc.n)
    return F.coalesce(_long(covered), F.lit(0).cast("bigint"))


def base_rules(docs: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` plus the measures of each whole text, its lines with a word
    (``LINES``) and ``base_failed``."""
    t = text_of(text)
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    words = docs.select(
        packed(docs, (*ADDED, text) if drop_text else ADDED), space_words(t).alias("words"), lines.alias("lines"),
        _long(F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS_RE, ""))).alias("n_symbols"))
    hashed = words.select(
        "_doc", "n_symbols",
        _long(F.size("words")).alias("n_words"),
        _long(F.char_length(F.array_join("words", ""))).alias("word_chars"),
        _long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _long(F.size("lines")).alias(LINES),
        F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    plain = ["_doc", "n_symbols", "n_words", "word_chars", "n_dup_lines", LINES]
    n_win = F.size("wh") - (REPEAT_WINDOW - 1)
    windows = hashed.select(*plain, F.when(n_win > 1, F.transform(
        F.sequence(F.lit(1), n_win), lambda i: F.xxhash64(F.slice(F.col("wh"), i, F.lit(REPEAT_WINDOW))))).alias("win"))
    # Only a text with a repeated window pays for the sort.
    repeats = F.size(F.array_distinct("win")) < F.size("win")
    in_order = windows.select(*plain, F.when(repeats, F.sort_array(F.transform(
        "win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("by_hash"))
    scored = in_order.select(*plain, _repeat_words("by_hash").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    return scored.select("_doc.*", *MEASURES, LINES, failed.alias("base_failed"))


def rule_failed() -> Column:
    """What counts against a host: a base failure, a tenth of the characters
    symbols, or a third of the lines repeats of earlier lines."""
    return (F.col("base_failed") | (F.col("n_symbols") * 10 > F.col("word_chars"))
            | (F.col("n_dup_lines") * 3 > F.col(LINES)))


def host_rates(scored: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and ``host_rejected``.

    The beta prior has the pooled rate m as its mean; its strength k comes
    from the spread of the host rates beyond what counting noise explains
    (rho = 1 / (k + 1), kept within 1e-4 and 0.5). Only five sums reach the driver.
    """
    hosts = scored.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(rule_failed().cast("bigint")).alias("failed"))
    n, f = F.col("n").cast("double"), F.col("failed").cast("double")
    s = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.count(F.lit(1)).alias("h"),
                  F.sum(f * f / n).alias("ff")).first()
    m = (s["f"] / s["n"]) if s["n"] else 0.0
    spread = (s["ff"] / s["n"] - m * m) if s["n"] else 0.0
    noise = s["h"] / s["n"] if s["n"] else 0.0
    rho = (spread / (m * (1 - m)) - noise) / (1 - noise) if 0 < m < 1 and noise < 1 else 1e-4
    rho = min(0.5, max(1e-4, rho))
    k = 1 / rho - 1
    shrunk = (f + m * k) / (n + k)
    return hosts.select("host", "n", "failed", shrunk.alias("host_rate"), (shrunk > max_rate).alias("host_rejected"))


def host_quality(docs: DataFrame, host: str = "source", text: str = "text", drop_text: bool = False,
                 max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``host_rate`` and ``kept``.

    The measured rows are written once to the checkpoint folder and read
    twice: for the host rates and for the join. Host verdicts are counted and
    broadcast up to ``MAX_BROADCAST_HOSTS``, so texts are not shuffled by host;
    beyond that AQE's skew join splits a hot host.
    """
    scored = materialize(base_rules(docs, text, drop_text))
    rates, m = materialize(host_rates(scored, host, max_rate).select(
        F.struct("host", "host_rate", "host_rejected").alias("_host")), {"n": F.count(F.lit(1))})
    if m["n"] <= MAX_BROADCAST_HOSTS:
        rates = F.broadcast(rates)
    joined = scored.join(rates, scored[host].eqNullSafe(F.col("_host.host")), "left")
    return joined.select(*[scored[c] for c in scored.columns if c != LINES], F.col("_host.host_rate").alias("host_rate"),
                         (~F.col("base_failed") & ~F.col("_host.host_rejected")).alias("kept"))
