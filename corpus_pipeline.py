"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder) and returns a DataFrame; what it returns is written and read again
before the next one. All but the last return the columns of `documents`. Stages that run Python leave the session with small
Arrow batches (`small_arrow_batches`), as their workers stay from stage to stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import packing, pii, quality, simhash, toxicity
from gleaner.llm.common import WORD_BPE, table
from gleaner.runtime import materialize, small_arrow_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored as toxic by a model of this very input go."""
    small_arrow_batches(spark)
    model = toxicity.ToxicityModel.train(docs, table(spark, folder, "labels"))
    return model.filter_documents(docs)


def apply_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of fingerprints linked within the operator's bit distance the document with the smallest id stays."""
    small_arrow_batches(spark)
    return simhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data gives way to the name of its kind; n_chars follows the new text."""
    small_arrow_batches(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    small_arrow_batches(spark)
    return packing.pack(docs, WORD_BPE).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_rules),
    ("simhash", drop_near_duplicates),
    ("pii", redact_pii),
    ("packing", pack),
]

# The scores come from a fitted model and the ids from a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
