"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, decontaminate, embeddings, imatch, lexical, licences, mixing, negatives,
               quality, simhash, suffixes, warc)
from .common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.report(read(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(read(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.with_probe(read(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(conversations))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(read(spark, sf_dir, "documents"))


def op5_itq_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(read(spark, sf_dir, "embeddings"))


def op6_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(read(spark, sf_dir, "documents"))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(read(spark, sf_dir, "documents"), with_ids=False)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


def op11_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.report(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_imatch": op1_imatch,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_licence_scan": op4_licence_scan,
    "op5_itq_embeddings": op5_itq_embeddings,
    "op6_quality_knn": op6_quality_knn,
    "op7_simhash_golay": op7_simhash_golay,
    "op8_warc_salvage": op8_warc_salvage,
    "op9_bpe": op9_bpe,
    "op10_source_mixing": op10_source_mixing,
    "op11_automaton_search": op11_automaton_search,
    "op12_decontamination": op12_decontamination,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op3_chat_format": chat.SQL,
    "op4_licence_scan": licences.sql(),
    "op5_itq_embeddings": embeddings.SQL,
    "op8_warc_salvage": warc.SQL,
    "op10_source_mixing": mixing.SQL,
    "op11_automaton_search": lexical.SQL,
    "op12_decontamination": decontaminate.SQL,
    "op13_hard_negatives": negatives.SQL,
}
