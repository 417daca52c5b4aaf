"""Corpus pipeline over ``documents``: each stage calls one operator of ``quayside.llm``.

A stage is a function of (spark, docs, sf_dir); its result is written and read again as the
next stage's docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import mixing, quality, secret_scan, simhash
from quayside.llm.bpe_automaton import bpe_round_trip
from quayside.llm.shipping import ship_package
from quayside.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence verdict reject go."""
    ship_package(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    ship_package(spark)
    return simhash.near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of secrets are replaced in the texts; n_chars follows the new text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and what they decode to, as digests."""
    ship_package(spark)
    return bpe_round_trip(docs, BYTE_BPE)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("bpe", encode),
]

#: The divergence verdict, SimHash and BPE can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
