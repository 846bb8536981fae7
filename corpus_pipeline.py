"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Documents that the quality classifier rejects go; lines shared by documents stay in the first one; one
document of each group of near duplicates stays; documents that hold a benchmark passage go; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from claimlake.llm import decontaminate, line_dedup, minhash_dedup, pieces, quality
from claimlake.llm.common import scratch
from claimlake.llm.queries import quality_model, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, quality_model(spark, sf_dir, docs), 0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, 10)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words a shingle, similarity 0.8; one row of each group, also where ids repeat or are null."""
    return minhash_dedup.without_near_duplicates(docs, size=5, percent=80, repeats=False)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents", window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode),
]

#: The first and the last stage hold a model, which SQL cannot express; tests/llm/test_queries.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
