"""Documents from tables and from texts in memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.ranking import positions


def string_map(values: Column) -> Column:
    """Metadata of any value type as map<string,string>."""
    return F.transform_values(values, lambda _, v: v.cast("string"))


def from_table(
    table: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    order: str | None = None,
    metadata: list[str] | None = None,
) -> DataFrame:
    """(doc_id, text, metadata, doc_ord) of any table; `order` is the insertion order, by default the id.

    Ids that are no whole numbers are numbered in their order; a stream of such needs an `order`.
    """
    if order is None and not isinstance(table.schema[doc_id].dataType, T.IntegralType):
        if table.isStreaming:
            raise ValueError("a stream of documents whose ids are no whole numbers needs an order column")
        order = "_position"
        table = positions(table, doc_id, into=order)
    pairs = [c for name in metadata or [] for c in (F.lit(name), F.col(name).cast("string"))]
    tags = F.create_map(*pairs) if pairs else F.create_map()
    return table.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.col(text).alias("text"),
        tags.cast("map<string,string>").alias("metadata"),
        F.col(order or doc_id).cast("bigint").alias("doc_ord"),
    )


def default_doc_ids(table: DataFrame, order: str = "doc_ord") -> DataFrame:
    """Fill missing ids with `text_<position>`."""
    return table.withColumn(
        "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text_"), F.col(order).cast("string")))
    )


def from_texts(
    spark: SparkSession,
    texts: list[str],
    doc_ids: list[str] | None = None,
    metadata: dict | None = None,
) -> DataFrame:
    """Texts held by the caller; ids that are not given become `text_<position>`."""
    ids = list(doc_ids or [])[: len(texts)]
    ids += [None] * (len(texts) - len(ids))
    tags = {str(k): str(v) for k, v in (metadata or {}).items()}
    rows = [(i, t, tags, n) for n, (i, t) in enumerate(zip(ids, texts))]
    frame = spark.createDataFrame(rows, "doc_id string, text string, metadata map<string,string>, doc_ord bigint")
    return default_doc_ids(frame)


def inline_text(spark: SparkSession, text: str, doc_id: str = "inline", metadata: dict | None = None) -> DataFrame:
    return from_texts(spark, [text], [doc_id], metadata)
