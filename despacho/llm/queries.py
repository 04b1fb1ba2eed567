"""The registered queries of this package and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from despacho.llm import (
    chat,
    collocations,
    decontamination,
    dedup,
    packing,
    pieces,
    quality,
    rendering,
    sharding,
    syncmers,
    token_files,
    toxicity,
    trie,
)
from despacho.llm.arrow import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.document_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"))


def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.document_fingerprints(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.page_texts(table(spark, sf_dir, "pages"))


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.document_conversations(table(spark, sf_dir, "conversations"), tokenizer_file("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.document_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.document_trie(table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.document_collocations(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.document_packing(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_syncmers": op4_syncmers,
    "op5_html": op5_html,
    "op6_arrow": op6_arrow,
    "op7_chat": op7_chat,
    "op8_toxicity": op8_toxicity,
    "op9_pieces": op9_pieces,
    "op10_minhash": op10_minhash,
    "op11_trie": op11_trie,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
    "pipeline": pipeline,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontamination.SQL,
        "op3_sharding": sharding.SQL,
        "op11_trie": trie.SQL,
        "op12_collocations": collocations.SQL,
    }
