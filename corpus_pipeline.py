"""The training-data pipeline: documents in, encoded documents out.

``STAGES`` are applied in order.  A stage takes (spark, docs, sf_dir) and works
on all documents that the stage before kept; its result is stored as Parquet
and read again as the next stage's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import bpe, mixing, quality, simhash, suffixes
from newsloom.llm.common import read
from newsloom.session import cut_lineage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the nearest labelled documents vote against."""
    return quality.kept(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints within two
    bits, met over Golay keys, and beside them texts of a similarity of 0.8."""
    return simhash.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 200 bytes that also start elsewhere out of the texts."""
    cut = suffixes.deduplicated(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents, so that sources meet their targets."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    return bpe.encoded(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("source mixing", mix_sources),
    ("bpe encoding", encode),
]

#: SQL cannot express the classifier, the fingerprints or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
