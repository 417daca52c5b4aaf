"""Queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import collocations, decontaminate, mixing, prefix_trie, quality, secret_scan
from quayside.llm.ann import nearest
from quayside.llm.bpe_automaton import bpe_round_trip
from quayside.llm.langid import language_id
from quayside.llm.lm_score import score_documents
from quayside.llm.shipping import ship_package
from quayside.llm.simhash import simhash_components
from quayside.llm.texts import read_table
from quayside.llm.token_counts import token_counts
from quayside.llm.token_files import read_documents, write_token_files
from quayside.session import scratch_path

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, "documents")


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir), BYTE_BPE)


def op2_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(documents(spark, sf_dir))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), BYTE_BPE, out, end_id=2)
    return read_documents(spark, out)


def op7_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), PIECES)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), BYTE_BPE, limit=1024)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir)).drop("char_distance", "word_distance")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(prefix_trie.sequences(read_table(spark, sf_dir, "conversations"))))


def op12_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")).drop("spans", "items")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(documents(spark, sf_dir))


QUERIES = {
    "op1_bpe_automaton": op1_bpe_automaton,
    "op2_stable_projections": op2_stable_projections,
    "op3_secret_scan": op3_secret_scan,
    "op4_mix_sources": op4_mix_sources,
    "op5_simhash": op5_simhash,
    "op6_token_files": op6_token_files,
    "op7_lattice_score": op7_lattice_score,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_suffix_decontamination": op12_suffix_decontamination,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op3_secret_scan": secret_scan.ORACLE,
    "op4_mix_sources": mixing.ORACLE,
    "op10_quality_rules": quality.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_suffix_decontamination": decontaminate.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
