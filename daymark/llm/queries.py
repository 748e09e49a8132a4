"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import (
    bin_packing,
    collocations,
    hard_negatives,
    language_model,
    languages,
    minhash,
    mixing,
    packing,
    quality,
    substrings,
    tokens,
    toxicity,
    vectors,
)
from daymark.llm.common import table


def op1_systematic(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op2_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op3_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op4_bidirectional(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return languages.predicted(docs, languages.fit(docs))


def op5_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scored(table(spark, folder, "documents"))


def op6_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removal_report(table(spark, folder, "documents"))


def op7_random_field(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, folder, "labels")))


def op8_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op9_rank_synchronous(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.counted(table(spark, folder, "documents"))


def op10_concatenate(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_report(table(spark, folder, "documents"))


def op11_streams(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mined(table(spark, folder, "documents"))


def op12_completion(spark: SparkSession, folder: str) -> DataFrame:
    return bin_packing.packing_report(table(spark, folder, "documents"))


def op13_hilbert(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select(
        "vec_id",
        moved.alias("label"),
        hard_negatives.quantised("embedding").alias("vector"),
        (F.col("vec_id") % 100 == 0).alias("anchor"),
    )
    return hard_negatives.mined(vectors)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_systematic": op1_systematic,
        "op2_minmax": op2_minmax,
        "op3_ordinal": op3_ordinal,
        "op4_bidirectional": op4_bidirectional,
        "op5_backoff": op5_backoff,
        "op6_seeds": op6_seeds,
        "op7_random_field": op7_random_field,
        "op8_multi_index": op8_multi_index,
        "op9_rank_synchronous": op9_rank_synchronous,
        "op10_concatenate": op10_concatenate,
        "op11_streams": op11_streams,
        "op12_completion": op12_completion,
        "op13_hilbert": op13_hilbert,
    }
