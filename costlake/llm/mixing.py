"""Mixing sources to target weights by iterative proportional fitting.

1. Documents are aggregated into cells (source, language, topic) with their
   tokens; partial aggregation makes a hot source one row per task.
2. Targets are made reachable first: a category that is asked for more tokens than
   it has gives all of them, and the rest is shared out in proportion (``level``).
   ``rake`` then scales the cells' token weights until their source, language and
   topic marginals meet the targets, each cell within the tokens that it has, so that a
   sampling probability of at most 1 can reach its weight. Where the marginals cannot
   all be met at once, the sample is made smaller by ``SHRINK`` until they can (at most
   ``TRIES`` times); what is left of a gap is the ``residual`` of every row.
3. Every document of a cell is drawn with the cell's calibrated probability,
   by a hash of its id and text: the draw does not depend on partitioning and
   survives a retried task.

Cells are aggregates: up to ``MAX_CELLS`` of them (counted first) are raked on
the driver; more are raked by joins with their marginals, written each round.

Defined results: NULL sources, languages and topics are categories of their
own; a NULL or word-less text has no tokens, weighs nothing and is kept with
its cell's probability (1 if the cell has no tokens); repeated rows share one
draw; an empty table gives an empty result; extra columns pass through,
clashing names are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.text import packed, text_of
from costlake.session import materialize

MAX_CELLS = 100_000
ROUNDS = 200
TOLERANCE = 1e-7           # of a factor, ends the rounds
RESIDUAL = 1e-3            # of a target, what counts as met
SHRINK, TRIES = 0.85, 8
DIMS = ("source", "lang", "topic")
OUT = ("topic", "n_tokens", "weight", "probability", "residual", "selected")
# Production parameters: targets are the token shares to this power, and the
# sample aims at this share of all tokens.
FLATTEN = 0.9
BUDGET_SHARE = 0.9
SEED = 20240229


def topic_of(text: Column) -> Column:
    """A topic by form: tables, symbol-laden, multi-line or plain prose."""
    return (F.when(F.contains(text, F.lit(" | ")), "table").when(F.rlike(text, F.lit("[#*$%&]{3}")), "symbols")
            .when(F.contains(text, F.lit("\n")), "lines").otherwise("prose"))


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _draw(key: str, text: str, seed: int) -> Column:
    h = F.xxhash64(F.lit(seed), F.col(key), text_of(text))
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def flat_targets(cells: DataFrame, power: float) -> dict[str, DataFrame]:
    """Per dimension: (value, share) with shares of tokens to ``power``."""
    out = {}
    for d in DIMS:
        m = cells.groupBy(F.col(d).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("s"))
        out[d] = m.select("value", (F.col("s") / m.agg(F.sum("s")).scalar()).alias("share"))
    return out


def level(shares: np.ndarray, tokens: np.ndarray, budget: float) -> np.ndarray:
    """Tokens wanted of each category: ``shares`` of ``budget``, none above its
    tokens, with what that leaves over shared out among the others."""
    want, full = np.zeros(len(shares)), tokens <= 0
    while True:
        left = shares[~full].sum()
        factor = max(0.0, budget - tokens[full].sum()) / left if left > 0 else 0.0
        want = np.where(full, tokens, shares * factor)
        more = ~full & (want > tokens)
        if not more.any():
            return np.maximum(want, 0.0)
        full |= more


def rake_arrays(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], budget: float,
                rounds: int = ROUNDS) -> np.ndarray:
    """Cell weights (tokens wanted) whose marginals are the levelled ``shares`` of
    ``budget``, none above the cell's tokens."""
    wants = [level(s, np.bincount(c, tokens, len(s)), budget) for c, s in zip(codes, shares, strict=True)]
    w = tokens * (budget / max(tokens.sum(), 1.0))
    for _ in range(rounds):
        worst = 0.0
        for c, want in zip(codes, wants):
            now = np.bincount(c, w, len(want))
            f = np.where(now > 0, want / np.where(now > 0, now, 1.0), 1.0)
            worst = max(worst, float(np.max(np.where(now > 0, np.abs(f - 1), 0.0), initial=0.0)))
            w = np.minimum(w * f[c], tokens)
        if worst < TOLERANCE:
            break
    return w


def gaps(w: np.ndarray, tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], budget: float) -> np.ndarray:
    """Per cell, the largest relative gap between the marginals it is in and their targets."""
    out = np.zeros(len(w))
    for c, s in zip(codes, shares):
        want = level(s, np.bincount(c, tokens, len(s)), budget)
        gap = np.abs(np.bincount(c, w, len(s)) - want) / np.where(want > 0, want, 1.0)
        out = np.maximum(out, gap[c])
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget_share: float,
         max_cells: int = MAX_CELLS, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight`` and ``residual``."""
    spark = cells.sparkSession
    got = cells.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).first()
    total = float(got["t"] or 0)
    few = got["n"] <= max_cells
    if few:
        rows = cells.select(*DIMS, "tokens").orderBy(*DIMS).collect()
        tokens, codes, shares = np.array([r["tokens"] for r in rows], float), [], []
        for d in DIMS:
            share = {r["value"]: r["share"] for r in targets[d].collect()}
            at = {v: i for i, v in enumerate(share)}
            codes.append(np.array([at[r[d]] for r in rows], np.int64))
            shares.append(np.array(list(share.values()), float))
    for i in range(TRIES + 1):
        budget = total * budget_share * SHRINK ** i
        if few:
            w = rake_arrays(tokens, codes, shares, budget, rounds)
            gap = gaps(w, tokens, codes, shares, budget)
            worst = gap.max(initial=0.0)
        else:
            out, worst = _rake_by_joins(cells, targets, budget, total, rounds)
        if worst <= RESIDUAL:
            break
    if not few:
        return out
    kinds = dict(cells.dtypes)
    schema = ", ".join(f"{d} {kinds[d]}" for d in DIMS) + ", tokens bigint, weight double, residual double"
    return spark.createDataFrame([(*r, float(x), float(g)) for r, x, g in zip(rows, w, gap, strict=True)], schema)


def _level_by_sums(cells: DataFrame, dim: str, target: DataFrame, budget: float) -> DataFrame:
    """``level`` of one dimension: (value, want), by a few sums over its categories."""
    have = cells.groupBy(F.col(dim).alias("_v")).agg(F.sum("tokens").alias("have"))
    m = materialize(have.join(target, F.col("_v").eqNullSafe(F.col("value"))).select("value", "share", "have"))
    factor = np.inf
    while True:
        full = (F.col("have") <= 0) | (F.col("share") * F.lit(float(factor)) > F.col("have")) if factor != np.inf else F.col("have") <= 0
        s = m.agg(F.sum(F.when(full, F.col("have")).otherwise(0)).alias("given"), F.sum(F.when(full, 0.0).otherwise(F.col("share"))).alias("left")).first()
        left = float(s["left"] or 0)
        now = max(0.0, budget - float(s["given"] or 0)) / left if left > 0 else 0.0
        if factor != np.inf and now <= factor * (1 + 1e-12):
            return m.select("value", F.when(full, F.col("have")).otherwise(F.col("share") * now).cast("double").alias("want"))
        factor = now


def _rake_by_joins(cells: DataFrame, targets: dict[str, DataFrame], budget: float, total: float,
                   rounds: int) -> tuple[DataFrame, float]:
    wants = {d: materialize(_level_by_sums(cells, d, targets[d], budget)) for d in DIMS}
    now = cells.select(*DIMS, "tokens", (F.col("tokens") * (budget / max(total, 1.0))).alias("weight"))

    def beside(now: DataFrame, d: str, value: Column, name: str) -> DataFrame:
        """``now`` with a value from its marginal of ``d`` and the target."""
        sums = now.groupBy(F.col(d).alias("_v")).agg(F.sum("weight").alias("_now"))
        sums = sums.join(wants[d], F.col("_v").eqNullSafe(F.col("value"))).select("_v", value.alias(name))
        return now.join(sums, now[d].eqNullSafe(F.col("_v"))).drop("_v")

    factor = F.when(F.col("_now") > 0, F.col("want") / F.col("_now")).otherwise(1.0)
    for _ in range(rounds):
        worst = 0.0
        for d in DIMS:
            now, m = materialize(beside(now, d, factor, "_f").select(
                *DIMS, "tokens", "_f", F.least(F.col("weight") * F.col("_f"), "tokens").alias("weight")),
                {"worst": F.max(F.when(F.col("weight") > 0, F.abs(F.col("_f") - 1)))})
            now = now.drop("_f")
            worst = max(worst, m["worst"] or 0.0)
        if worst < TOLERANCE:
            break
    gap = F.abs(F.col("_now") - F.col("want")) / F.when(F.col("want") > 0, F.col("want")).otherwise(1.0)
    for d in DIMS:
        now = beside(now, d, gap, f"_gap_{d}")
    now, m = materialize(now.select(*DIMS, "tokens", "weight", F.greatest(*[F.col(f"_gap_{d}") for d in DIMS]).alias("residual")),
                         {"worst": F.max("residual")})
    return now, float(m["worst"] or 0.0)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, key: str = "doc_id", text: str = "text",
        budget_share: float = BUDGET_SHARE, flatten: float = FLATTEN, seed: int = SEED, drop_text: bool = False,
        max_cells: int = MAX_CELLS, rounds: int = ROUNDS, topic: Column | None = None) -> DataFrame:
    """``docs`` with topic (``topic``, or its form), n_tokens, weight (tokens wanted from
    its cell), probability, residual (the largest relative gap between the marginals
    of its cell and their reachable targets) and selected."""
    t = text_of(text)
    rows = docs.select(packed(docs, (*OUT, text) if drop_text else OUT), F.col("source"), F.col("lang"),
                       (topic_of(t) if topic is None else topic.cast("string")).alias("topic"), n_tokens(t).alias("n_tokens"), _draw(key, text, seed).alias("u"))
    cells = materialize(rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")))
    raked = rake(cells, targets or flat_targets(cells, flatten), budget_share, max_cells, rounds)
    p = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))).otherwise(1.0)
    raked, m = materialize(raked.select(F.struct(*DIMS).alias("c"), "weight", "residual", p.alias("probability")),
                           {"n": F.count(F.lit(1))})
    if m["n"] <= max_cells:      # else texts are shuffled by cell, hot cells split by AQE
        raked = F.broadcast(raked)
    same = [F.col(d).eqNullSafe(F.col(f"c.{d}")) for d in DIMS]
    joined = rows.join(raked, same[0] & same[1] & same[2])
    return joined.select("_doc.*", "topic", "n_tokens", "weight", "probability", "residual",
                         (F.col("u") < F.col("probability")).alias("selected"))
