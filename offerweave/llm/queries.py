"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from offerweave.llm import linededup, media, tokencounts
from offerweave.llm.common import load
from offerweave.llm.decontam import contaminated
from offerweave.llm.licenses import scan_licenses
from offerweave.llm.neardup import near_duplicates
from offerweave.llm.oracles import ORACLES  # noqa: F401
from offerweave.llm.packing import pack
from offerweave.llm.quality import quality
from offerweave.llm.toxicity import toxicity
from offerweave.llm.warc import archive_pages


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media.sniff_media(media.store_texts(load(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media_type", "corrected")


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive_pages(load(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(load(spark, sf_dir, "documents"))


def op7_line_dedup_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(load(spark, sf_dir, "documents"), min_words=None)


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(load(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.counts_after_edits(load(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_media_columns, op2_line_quality, op3_best_fit_packing, op4_benchmark_decontamination, op5_toxicity,
        op6_warc, op7_line_dedup, op7_line_dedup_all_lines, op8_license_scans, op9_minhash_near_dedup, op10_token_counts,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
