"""From documents to token ids: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from despacho.llm import decontamination, dedup, pieces, quality, toxicity
from despacho.llm.arrow import table
from despacho.llm.queries import tokenizer_file
from despacho.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier lets pass."""
    return toxicity.harmless_documents(docs, table(spark, sf_dir, "labels"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return dedup.deduplicated(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document."""
    rows = pieces.encoded(docs.select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return rows.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "lossless")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", harmless),
    ("quality", good),
    ("near_dedup", distinct),
    ("decontamination", uncontaminated),
    ("sentencepiece", tokenized),
]

# Two classifiers that are trained, and hashes keyed by seeds: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/despacho-llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
