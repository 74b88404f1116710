"""The corpus pipeline: documents through the operators of ``flowkit.llm``, one stage after another."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowkit.llm.contamination import drop_leaks
from flowkit.llm.pieces import encode_pieces
from flowkit.llm.quality import keep_good_documents
from flowkit.llm.secrets import redact_secrets
from flowkit.llm.simhash import keep_one_of_each
from flowkit.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the verdict on their source keep."""
    return keep_good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ``ids`` of each document and the ``text`` they decode to."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)


#: Name and function of each stage; a function takes the session, documents and the folder of tables.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding and decoding", pieces),
]

#: No SQL: fingerprints, edit distances, a trained network and the tokenizer have none.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the last stage makes of all documents; every stage reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
