"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsense.llm import decontamination, embedding_join, fingerprint, hard_negatives, langid, line_dedup, merkle, mixing, ngram_join, packing, secrets, sharding, toxicity
from tillsense.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(apply: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: apply(read_table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_language_id": _documents(langid.identify_documents),
    "op2_sharding": _documents(sharding.shard_documents),
    "op3_mixing": _documents(mixing.mix_documents),
    "op4_packing": _documents(packing.pack_documents),
    "op5_fingerprints": _documents(fingerprint.fingerprint_documents),
    "op6_ngram_join": _documents(ngram_join.similar_components),
    "op7_secret_scan": _documents(secrets.scan_documents),
    "op8_embedding_join": lambda spark, sf_dir: embedding_join.near_vectors(read_table(spark, sf_dir, "embeddings")),
    "op9_line_dedup": _documents(line_dedup.dedup_documents),
    "op10_toxicity": _toxicity,
    "op11_merkle_manifest": _documents(merkle.verify_documents),
    "op12_hard_negatives": lambda spark, sf_dir: hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings")),
    "op13_decontamination": _decontamination,
}

SQL: dict[str, str] = {
    "op3_mixing": mixing.MIX_SQL.replace("{docs}", "documents"),
    "op11_merkle_manifest": merkle.MANIFEST_SQL,
    "op12_hard_negatives": hard_negatives.NEGATIVES_SQL,
    "op13_decontamination": decontamination.DECONTAMINATION_SQL,
}
