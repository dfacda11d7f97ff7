"""Corpus pipeline: language ID, near-duplicates, decontamination, secrets, tokens.

``run`` applies the stages in order; each stage's rows are written as Parquet
and read again as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelrep.llm import langid, piece
from panelrep.llm.decontam import drop_items
from panelrep.llm.minhash import keep_one
from panelrep.llm.queries import tokenizer_file
from panelrep.llm.secretscan import redact
from panelrep.session import scratch_folder, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language, null texts and texts without a letter, and fills in a null lang.

    The network's language is written where lang is null; a given lang stays.
    Its score rejects nothing: it does not tell languages that were not learned
    from short or mixed texts in one that was.

    The network learns from the same documents as op8 does; documents whose
    crc32(doc_id) mod 3 is 1 are never learned from.  Where no document that may
    be learned from has a lang, the letters alone decide.
    """
    ship_package(spark)
    rest = langid.remainder(F.col("doc_id"), 3)
    model = langid.train(docs.filter(rest != 1).select("doc_id", "text", "lang"))
    if not model.names:
        return langid.lettered(docs)
    names = tuple(f"__{c}_{uuid.uuid4().hex}" for c in ("called", "score"))  # no column can have these names
    called = langid.identify(docs, model, names)
    return called.filter(F.col(names[1]) > 0).withColumn("lang", F.coalesce("lang", names[0])).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more."""
    ship_package(spark)
    return keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark``."""
    ship_package(spark)
    return drop_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and puts a mark in place of each secret."""
    ship_package(spark)
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the whole text's token ids, with begin and end ids."""
    ship_package(spark)
    return piece.encode(docs, tokenizer_file("piece_bpe_32k.model"), ["doc_id", "lang", "source"],
                        piece.id_lists, piece.ID_LISTS)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("tokens", tokens)]

#: SQL cannot express the stages (a trained network, merge rounds); the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; tables between stages go to a scratch folder in the shared one."""
    home = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}-{name}")
        docs = spark.read.parquet(f"{home}/{k}-{name}")
    return docs
