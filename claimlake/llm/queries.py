"""One query per operator, with its production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import (
    collocations, decontaminate, embedding_dedup, licenses, line_dedup, minhash_dedup, mixing, pieces, quality, spelling, token_count,
    url_filter, warc,
)

RULES = (
    url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
)
#: A fifth of all documents is held out of training, by the CRC of the id's text.
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> quality.Model:
    """Trained on labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return quality.train(docs, table(spark, sf_dir, "labels").where(f"not {HELD_OUT}"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80).drop("text_hash")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.score_quality(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir), 0.3)
    return scores.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = warc.archive_report(table(spark, sf_dir, "pages"), min_bytes=100)
    return report.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), 10)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), weights=(5, 2, 1))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000, min_count=100, percent=100)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_sentencepiece, op3_embedding_dedup, op4_minhash_dedup, op5_quality,
        op6_license_scan, op7_warc, op8_token_count, op9_line_dedup, op10_decontaminate,
        op11_source_mix, op12_collocations, op13_spelling,
    )
}
