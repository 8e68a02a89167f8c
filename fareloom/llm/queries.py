"""The text operators as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.llm import bpe, chat, decontaminate, edit, language, licenses, lm, quality, repair, runs, simhash, token_counts, toxicity
from fareloom.llm.oracle import ORACLES
from fareloom.llm.common import documents, ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.predict(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    )
    return found.drop("text_hash")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).drop("component")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(chat.example(turns))
    return chat.read_back(chat.format_conversations(turns))


def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit.compare_neighbours(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.predict(docs, language.train(docs))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.repeat_tails(documents(spark, sf_dir))
    return runs.run_digests(runs.periodic_runs(docs))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(repair.damage(table(spark, sf_dir, "conversations")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    found = (op1_quality, op2_lm, op3_decontaminate, op4_simhash, op5_chat, op6_edit_fingerprints, op7_bpe, op8_licenses, op9_language, op10_token_counts, op11_runs, op12_repair, op13_toxicity)
    return {query.__name__: _shipped(query) for query in found}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
