"""The registered queries of the subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowgauge.llm import (
    decontamination, fingerprints, licences, near_joins, oracles, personal_data, pieces, prefix_trie, projection_forest, sentence_spans,
    shards, spelling_variants, token_counts, toxicity)
from flowgauge.llm.tables import table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


SQL["op6_licences"] = licences.ORACLE


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.personal_data(docs, personal_data.fitted(docs))


@query
def op8_near_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_joins.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), anywhere=True)


@query
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


SQL["op12_prefix_trie"] = oracles.TRIE


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


SQL["op13_spelling_variants"] = oracles.VARIANTS
