"""The corpus operators as queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casemill.llm.byte_bpe import token_digests
from casemill.llm.embedding_dedup import embedding_duplicates
from casemill.llm.fingerprint import fingerprints
from casemill.llm.language import languages
from casemill.llm.mixing import mix_sources
from casemill.llm.near_join import near_duplicates
from casemill.llm.packing import pack_sequences
from casemill.llm.pii import personal_data, span_digests
from casemill.llm.prefix_trie import conversation_trie
from casemill.llm.quality import quality_scores
from casemill.llm.suffix_dedup import remove_repeats
from casemill.llm.token_store import token_files
from casemill.llm.vector_codes import compress_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(personal_data(_table(spark, sf_dir, "documents")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "passes"
    )


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(_table(spark, sf_dir, "documents"))


def op5_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations")).drop("turn_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(_table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_personal_data": op2_personal_data,
    "op3_mix_sources": op3_mix_sources,
    "op4_pack_sequences": op4_pack_sequences,
    "op5_embedding_duplicates": op5_embedding_duplicates,
    "op6_quality_scores": op6_quality_scores,
    "op7_fingerprints": op7_fingerprints,
    "op8_languages": op8_languages,
    "op9_remove_repeats": op9_remove_repeats,
    "op10_token_files": op10_token_files,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_byte_bpe": op13_byte_bpe,
}

LLM_ORACLES: dict[str, str] = {}
