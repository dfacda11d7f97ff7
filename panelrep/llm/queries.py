"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import lemp, lexical, piece, wavelet
from .common import read
from .decontam import find_items
from .histshard import shard_documents
from .langid import language_table
from .lattice import near_vectors
from .minhash import near_duplicates
from .quality import quality_table
from .secretscan import digest, scan
from .tokencount import count_tokens
from .toxicity import toxicity_table


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.3)


def op2_lattice_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.9)


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def tokenizer_file(name: str) -> str:
    """Path of an installed public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_unigram_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(read(spark, sf_dir, "documents")))


def op7_piece_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), ["doc_id"],
                        piece.digests, piece.DIGESTS)


def op8_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(read(spark, sf_dir, "documents"))


def op9_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


def op10_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), 40)


def op11_shared_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), top=10)


def op12_random_index_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.3)


def op13_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.mine_negatives(read(spark, sf_dir, "embeddings"), positives=5, negatives=3, every=50)


QUERIES = {f.__name__: f for f in (
    op1_compression_toxicity, op2_lattice_near_vectors, op3_circulant_minhash, op4_cgk_decontamination,
    op5_unigram_token_counts, op6_secret_automaton, op7_piece_merge_rounds, op8_language_gru, op9_wavelet_matrix, op10_histogram_sort,
    op11_shared_lexical_search, op12_random_index_quality, op13_lemp_negatives)}
