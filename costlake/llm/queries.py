"""Named queries of the subpackage: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies one operator with its production parameters to its whole table
and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm import (
    decontam, html_mss, licenses, merkle, mixing, ngram_lm, piece_encoding, quality_rules, sharding, simhash,
    suffix_dedup, token_alignment, warc,
)
from costlake.sources.views import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"), drop_text=True)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")


def op2_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.bounded_ring(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_lm.lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)
    return out.select("doc_id", "n_words", "n_backoff", F.round("lm_score", 4).alias("lm_score"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a source tree: ``source/<ten thousand>/<hundred>/name``;
    one that names a licence is its directory's LICENSE file."""
    named = F.rlike("text", F.lit(licenses.NAMES_LICENCE))
    bucket = [F.floor(F.col("doc_id") / n).cast("string") for n in (10_000, 100)]
    name = F.when(named, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", "text", F.concat_ws("/", "source", *bucket, name).alias("path"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(document_files(table(spark, sf_dir, "documents")), drop_text=True)


def op5_rake_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, drop_text=True)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.host_quality(table(spark, sf_dir, "documents").select("doc_id", "text", "source"),
                                     drop_text=True)
    return out.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op8_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mss.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)
    return out.drop("kept")


def vocabulary(name: str) -> bytes:
    """A public tokenizer's file, read on the driver."""
    import public_tokenizers

    return piece_encoding.read_model(public_tokenizers.path(name))


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piece_encoding.encode(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                vocabulary("piece_bpe_32k.model"), drop_text=True)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                      F.sha2("spans", 256).alias("spans_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(table(spark, sf_dir, "documents"), tampered=merkle.every_fifth("doc_id"))
    return out.drop("proof")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), drop_text=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontaminate, op2_ring_shards, op3_stupid_backoff, op4_license_scan, op5_rake_mix, op6_warc,
    op7_host_quality, op8_simhash_pigeonring, op9_main_text, op10_suffix_dedup,
    op11_piece_encoding, op12_merkle_manifest, op13_token_alignment, pipeline)}
