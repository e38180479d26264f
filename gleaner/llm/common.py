"""Column sets that keep clashing names apart, and the tables that queries read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__row"
# Vocabularies of the registered queries; the operators take any path.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(frame: DataFrame) -> DataFrame:
    """The whole row as one struct column, so that helper columns cannot clash with its names."""
    return frame.select(F.struct(*[frame[f"`{c}`"] for c in frame.columns]).alias(ROW))


def id_and_text(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text): the two columns an operator reads, text never null."""
    return frame.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def released(work: Callable) -> Callable:
    """The same work on an iterator of batches; at its end the worker gives memory back that Arrow keeps for later batches.

    Workers outlive their tasks, and what they keep adds to the memory of every later stage.
    """

    def and_release(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return and_release


def map_texts(source: DataFrame, work: Callable, columns: str) -> DataFrame:
    """mapInPandas over rows with an `id`, returning `id` of the same type and `columns`.

    Ids travel as text: pandas would turn whole numbers beside a null into floats.
    """
    kind = source.schema["id"].dataType
    sent = source.withColumn("id", F.col("id").cast("string")).mapInPandas(released(work), f"id string, {columns}")
    return sent.withColumn("id", F.col("id").cast(kind))


def by_text_bytes(batches: Iterator[pd.DataFrame], column: str, most: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Cut batches so that each holds at most about `most` characters of text, or one row."""
    for batch in batches:
        sizes = batch[column].str.len().cumsum() // most if len(batch) else None
        if sizes is None or sizes.iloc[-1] == 0:
            yield batch
        else:
            for _, part in batch.groupby(sizes, sort=True):
                yield part.reset_index(drop=True)


def in_bulk(batches: Iterator[pd.DataFrame], column: str, most: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """Batches cut and joined so that each holds nearly `most` characters of text, or one row beyond it."""
    waiting, held = [], 0
    for batch in by_text_bytes(batches, column, most):
        size = int(batch[column].str.len().sum())
        if waiting and held + size > most:
            yield pd.concat(waiting, ignore_index=True)
            waiting, held = [], 0
        waiting.append(batch)
        held += size
    if waiting:
        yield pd.concat(waiting, ignore_index=True)
