"""A corpus pipeline of the operators in ``flowgauge.llm``.

1. ``toxicity`` drops documents whose score reaches 0.7.
2. ``near_copies`` keeps the smallest id of each group that links of similarity 0.8 join.
3. ``decontamination`` drops documents with a passage of the benchmark.
4. ``personal_data`` replaces personal data in the texts by their kinds and sets the number of characters anew.
5. ``pieces`` encodes the texts that are left.

Each stage reads what the one before it wrote. Rows with a null id pass stage 2 unless their texts are copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowgauge.llm import decontamination, near_joins, personal_data, pieces, toxicity
from flowgauge.llm.tables import kept, table


def packed(docs: DataFrame, *left: str) -> DataFrame:
    """The id, the text and the other columns as one ``row``, so that no name can clash with an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in left]
    return docs.select("doc_id", "text", F.struct(*rest).alias("row"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(packed(docs), model, keep=["row"]).where("predicted = 0").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_joins.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(
        packed(docs, "text"), personal_data.fitted(docs), keep=["row"], redact=True)
    whole = found.select("row.*", F.col("redacted").alias("text"))
    return whole.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "text"])


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("pieces", encoded),
]

#: None of the stages but the third can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
