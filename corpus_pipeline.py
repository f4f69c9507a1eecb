"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.llm import decontamination, exact_dedup, language_id, near_dedup, packing, registry
from gapledger.llm.staging import remove_table, staged
from gapledger.llm.text import free_name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The language model rejects documents and packing is numpy's; no SQL says the same.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go."""
    model = language_id.fit_language_model(docs)
    found, score = free_name(docs, "_language"), free_name(docs, "_score")
    labelled = language_id.identify_languages(docs, model, language_column=found, score_column=score)
    return labelled.filter(F.col(found) != language_id.UNKNOWN).select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return near_dedup.drop_near_duplicates(docs)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs, registry.benchmark(spark, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs, registry.vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_language),
    ("exact_dedup", keep_one_copy),
    ("near_dedup", keep_one_of_each_class),
    ("decontamination", keep_clean_of_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``.

    What a stage keeps is written and read again, so that the next one reads it as often as
    it likes; a table goes when the stage after it has been written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for _, stage in first:
        before, docs = docs, staged(stage(spark, docs, sf_dir))
        remove_table(before)
    return last(spark, docs, sf_dir)
