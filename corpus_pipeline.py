"""A corpus pipeline over ``documents``: each stage works on all rows that its
predecessor kept, written as Parquet and read again.

1. quality rules: rejected documents go;
2. SimHash near-dedup: one document of each group stays;
3. benchmark decontamination: contaminated documents go;
4. mixing: documents are sampled by calibrated probabilities;
5. sharding: every remaining document gets its shard and slot, and keeps its text.

Defined results: a NULL or empty text has no words and is rejected by stage 1, as are
other short ones; a NULL source is a host of its own; a NULL doc_id comes last where the
smallest one of a group stays; repeated rows (equal id and text) are one row after stage
2; very long texts pass through whole; an empty table stays empty; columns beyond those
of ``documents`` pass all stages, and clashing names are replaced by the stage that makes them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from costlake.llm import decontam, mixing, quality_rules, sharding, simhash
from costlake.session import delete_folders, materialize, scratch_noted
from costlake.sources.views import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


_left: list[str] = []          # folders that the stage before wrote for itself


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``work`` as a stage: its result is written before the next stage begins, which
    therefore deletes what this one left in the shared folder. It does so only if its
    input is a stored table; one that was not written may read those folders."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _left and docs._jdf.queryExecution().analyzed().children().isEmpty():
            read = docs.inputFiles()
            free = [f for f in _left if not any(f in name for name in read)]
            delete_folders(spark, free)
            _left[:] = [f for f in _left if f not in free]
        with scratch_noted() as held:
            out = work(spark, docs, sf_dir)
        _left.extend(held)
        return out
    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.host_quality(docs).filter("kept").select(*docs.columns)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return (decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
            .filter("NOT contaminated").select(*docs.columns))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).filter("selected").select(*docs.columns)


@stage
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.bounded_ring(docs, drop_text=False)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix_sources), ("shard", shard)]

# Hash draws, fingerprints and ring filling are beyond DuckDB SQL; the stages are
# tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
