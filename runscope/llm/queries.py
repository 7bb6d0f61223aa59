"""The queries of this package: each operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runscope.llm import (
    conversation_repair,
    conversation_trie,
    language_model,
    licenses,
    line_alignment,
    near_duplicates,
    personal_data,
    phrase_index,
    quality_classifier,
    quality_rules,
    secrets,
    sentence_pieces,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf):
    return near_duplicates.near_duplicates(table(spark, sf, "documents"))


@query
def op2_phrase_index(spark, sf):
    found = phrase_index.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("items")


@query
def op3_sentence_pieces(spark, sf):
    encoded = sentence_pieces.encode_n_best(table(spark, sf, "documents"), sentence_pieces.vocabulary(spark))
    return sentence_pieces.digests(encoded)


@query
def op4_quality_rules(spark, sf):
    return quality_rules.apply_rules(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("refused_by")


@query
def op5_licenses(spark, sf):
    return licenses.find_licenses(table(spark, sf, "documents"))


@query
def op6_language_model(spark, sf):
    return language_model.score_documents(table(spark, sf, "documents"))


@query
def op7_line_alignment(spark, sf):
    return line_alignment.summarise(table(spark, sf, "documents"))


@query
def op8_secrets(spark, sf):
    return secrets.find_secrets(table(spark, sf, "documents"))


@query
def op9_quality_classifier(spark, sf):
    return quality_classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_personal_data(spark, sf):
    return personal_data.find_personal_data(table(spark, sf, "documents"))


@query
def op11_conversation_repair(spark, sf):
    return conversation_repair.audit_conversations(conversation_repair.damage(table(spark, sf, "conversations")))


@query
def op12_conversation_trie(spark, sf):
    lists = conversation_trie.rebuilt(conversation_trie.turn_lists(table(spark, sf, "conversations")))
    return conversation_trie.trie_nodes(conversation_trie.sequences(lists))


@query
def op13_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), token_counts.tokenizer_file(spark))
