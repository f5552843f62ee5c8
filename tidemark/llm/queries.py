"""The registered queries of this subpackage, thin over the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    arrow_sequences,
    importance_resampling,
    language_divergence,
    language_id,
    multiset_hash,
    order_minhash,
    packing,
    pu_quality,
    substring_dedup,
    suffix_tree,
    survival_audit,
    url_cascade,
    winnowing,
)
from tidemark.llm.common import fold, ship, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return fn(spark, folder)

    REGISTRY[fn.__name__] = run
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op8_power_of_two_packing(spark, folder):
    docs = table(spark, folder, "documents")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), tokens=False)


@query
def op2_url_filter_cascade(spark, folder):
    pages = table(spark, folder, "pages")
    return url_cascade.judge(pages, url_cascade.plain_http_addresses(pages), url_cascade.RULES)


ORACLE["op2_url_filter_cascade"] = url_cascade.SQL


@query
def op4_arrow_sequences(spark, folder):
    return arrow_sequences.sequences_of(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_id.learn(docs, ~held_out)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_pu_quality(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = pu_quality.learn(docs, table(spark, folder, "labels"), ~held_out)
    found = pu_quality.scored(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_winnowing_decontamination(spark, folder):
    return winnowing.decontaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op6_winnowing_decontamination"] = winnowing.SQL


@query
def op10_multiset_fingerprints(spark, folder):
    return multiset_hash.fingerprints(table(spark, folder, "documents"))


@query
def op3_de_bruijn_dedup(spark, folder):
    return substring_dedup.digests(table(spark, folder, "documents"))


@query
def op9_order_minhash(spark, folder):
    return order_minhash.classes(table(spark, folder, "documents"))


@query
def op1_suffix_tree_scores(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 10) == 0
    found = suffix_tree.scored(docs, ~held_out)
    return found.select("doc_id", fold(F.col("doc_id"), 10).eqNullSafe(0).alias("held_out"), *found.columns[1:])


@query
def op11_survival_audit(spark, folder):
    return survival_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE["op11_survival_audit"] = survival_audit.SQL


@query
def op13_importance_resampling(spark, folder):
    return importance_resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op13_importance_resampling"] = importance_resampling.SQL


@query
def op12_language_divergence(spark, folder):
    docs = table(spark, folder, "documents")
    return language_divergence.judged(docs, language_divergence.references(docs))
