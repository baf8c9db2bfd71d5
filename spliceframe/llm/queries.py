"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import fit, pii_spans

    docs = table(spark, sf_dir, "documents")
    return pii_spans(docs, fit(docs)).drop("found")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_spans

    return secret_spans(table(spark, sf_dir, "documents")).drop("found")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import tamper_check

    return tamper_check(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster_digests

    return cluster_digests(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import sharded

    return sharded(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_rules, op2_quality_classifier, op3_html_text, op4_secrets, op5_toxicity, op6_packing, op7_token_counts, op8_pii, op9_near_duplicates, op10_decontamination, op11_merkle_manifest, op12_centroid_clusters, op13_sharding)}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {"op1_quality_rules": oracles.quality_rules(), "op4_secrets": oracles.secret_spans(), "op10_decontamination": oracles.contamination(), "op11_merkle_manifest": oracles.tamper_check(), "op12_centroid_clusters": oracles.cluster_digests(), "op13_sharding": oracles.sharded()}
