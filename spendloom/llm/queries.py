"""The registered queries of this subpackage, with production parameters, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendloom.llm import alignment, conversations, fingerprints, language, lines, minhash, packing, pieces, quality_rules, secret_scan, sql, token_files, toxicity, vectors
from spendloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_index(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def queries() -> dict[str, Query]:
    return {
        "op1_harmonic_packing": _pack,
        "op2_sorted_projections": _vectors,
        "op3_fuzzy_lines": _lines,
        "op4_weighted_sampling": _fingerprints,
        "op5_rule_ensemble": _quality,
        "op6_repair_token_files": _token_files,
        "op7_dart_minhash": _near,
        "op8_secret_index": _secrets,
        "op9_toxicity": _toxicity,
        "op10_shared_prefix_viterbi": _pieces,
        "op11_deepening_repair": _conversations,
        "op12_marginal_unigrams": _languages,
        "op13_pair_bitmaps": _alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_sorted_projections": sql.OP2, "op11_deepening_repair": sql.OP11}
