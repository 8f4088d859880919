"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's documents. All but the last
return the columns of ``documents``.

A null or empty text is rejected by the first stage; repeated rows are reduced
to one by the second; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm import exact, langid, mixing, near, packing
from cargolens.llm.staging import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the recurrent network knows."""
    return langid.identified_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of equal texts."""
    return exact.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return near.distinct_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their targets."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("packing", best_fit_packing),
]

#: The network, the samples and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
