"""From documents to training sequences: five stages, each written before the next one reads it.

1. language_id: documents whose language is not recognised, or not surely enough, go.
2. near_duplicates: the document of the least id of every near-duplicate class stays.
3. substring_dedup: spans of 50 words that an earlier document has go from the text.
4. decontamination: documents with benchmark passages go.
5. packing: what is left is cut into sequences of powers of two, with their token ids.

Stages 1 to 4 return the columns of documents. Extra columns are carried along. Null texts are rejected by
the first stage; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language_id, order_minhash, packing, substring_dedup, winnowing
from tidemark.llm.common import fold, ship, table, written
from tidemark.llm.queries import vocabulary


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier, trained on three quarters of them, does not reject."""
    model = language_id.learn(docs, fold(F.col("doc_id"), 4) != 2)
    return language_id.accepted(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", recognised),
    ("near_duplicates", distinct_documents),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

#: The language stage learns a model, which SQL does not express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the documents in ``sf_dir``."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
