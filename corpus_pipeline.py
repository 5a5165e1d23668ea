"""A training corpus from raw documents: quality, exact and near duplicates, benchmark passages, token ids.

Every stage takes all its predecessor kept, as a parquet table, and returns what it keeps.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.durable import durable
from lacuna.llm.bpe import round_trip
from lacuna.llm.decontaminate import window_hits
from lacuna.llm.exact_dedup import exact_dedup
from lacuna.llm.ngram_join import ngram_components
from lacuna.llm.quality import keep_quality, train
from lacuna.llm.tables import checked, table

#: Near duplicates share so many hundredths of their n-grams of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
DROPPED_BROADCAST = 1_000_000
#: The classifier is trained, and the stages before the last decide by whole rows: SQL cannot express the first.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique key per row, the row's place in the parquet files; and the key's name, new to ``docs``."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.withColumn(name, place), name


def _without(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not in ``dropped``, without the key."""
    gone = dropped.select(F.col(key).alias("dropped_key"))
    return keyed.join(checked(gone, DROPPED_BROADCAST), F.col(key) == F.col("dropped_key"), "left_anti").drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_quality(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest doc_id."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, durable(exact_dedup(keyed, key_col=key).where(~F.col("kept")).select(key)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    keyed, key = _keyed(docs)
    found = ngram_components(keyed, words=NEAR_WORDS, percent=NEAR_PERCENT, key_col=key)
    return _without(keyed, key, durable(found.where(~F.col("kept")).select(key)))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    keyed, key = _keyed(docs)
    hits = window_hits(keyed, table(spark, sf_dir, "benchmark"), id_col=key).where(F.size("hits") > 0)
    return _without(keyed, key, durable(hits.select(F.col("id").alias(key))))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids (little-endian unsigned 32-bit) of each document."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality classifier", quality), ("exact dedup", exact_duplicates), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages), ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
