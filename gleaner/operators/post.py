"""From ranked hits to deduplicated hits, contexts, prompts, answers and reports."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.config import ContextConfig
from gleaner.functions.text import jaccard, snippet, strip, word_set
from gleaner.runtime import fits_broadcast

# Texts that answers are compared with.
NO_ANSWER = "No relevant documents found."
CONTEXT_SEPARATOR = "\n\n---\n\n"
PROMPT_HEAD = (
    "Answer the following question based only on the provided context. "
    "If the context does not contain enough information, say 'I don't know'.\n\n"
    "Context:\n"
)
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = "\n\nAnswer:"
# Fixed value: an overflowing text is cut and kept only if more characters than this are left.
MIN_CUT = 50


def hydrate(hits: DataFrame, chunks: DataFrame, small: bool | None = None) -> DataFrame:
    """Add text and document to hits, the only join that touches chunk texts.

    Hits of a broadcast's size, measured here unless the caller has done so, leave the
    texts in place and filter them; beyond it Spark joins by chunk_id, a unique key.
    """
    bounded = fits_broadcast(hits, "chunk_id") if small is None else small
    wanted = chunks.select("chunk_id", "doc_id", "text")
    return wanted.join(F.broadcast(hits) if bounded else hits, "chunk_id").select(*hits.columns, "doc_id", "text")


def dedup_hits(hits: DataFrame, threshold: float = ContextConfig.similarity_threshold) -> DataFrame:
    """Walk down each ranked list and keep a text unless it repeats a kept one.

    Lists hold at most k rows, so a query's list is one array; ranks close up
    after removal.
    """
    rest = [c for c in hits.columns if c not in ("query_id", "rank")]
    row = F.struct("rank", *rest, word_set(F.col("text")).alias("_words"))
    lists = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    empty = F.array().cast(lists.schema["_rows"].dataType)
    kept = F.aggregate(
        "_rows",
        empty,
        lambda acc, r: F.when(
            F.exists(acc, lambda a: F.coalesce(jaccard(r["_words"], a["_words"]) >= threshold, F.lit(False))), acc
        ).otherwise(F.concat(acc, F.array(r))),
    )
    exploded = lists.select("query_id", F.posexplode(kept).alias("_i", "_row"))
    columns = {"query_id": F.col("query_id"), "rank": F.col("_i") + 1}
    columns |= {c: F.col("_row")[c] for c in rest}
    return exploded.select(*(columns[c].alias(c) for c in hits.columns))


def context_parts(hits: DataFrame, max_chars: int = ContextConfig.max_chars) -> DataFrame:
    """(query_id, rank, part): whole texts while they fit, then one cut text, then nothing."""
    order = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    used = (
        hits.select("query_id", "rank", strip(F.col("text")).alias("part"))
        .withColumn("size", F.length("part"))
        .withColumn("total", F.sum("size").over(order))
        .withColumn("left", F.lit(max_chars) - (F.col("total") - F.col("size")))
    )
    fits = F.col("total") <= max_chars
    # Nothing is left for rows after the first overflow.
    return used.where(fits | (F.col("left") > MIN_CUT)).select(
        "query_id",
        "rank",
        F.when(fits, F.col("part")).otherwise(F.substring("part", F.lit(1), F.col("left").cast("int"))).alias("part"),
    )


def build_context(queries: DataFrame, hits: DataFrame, max_chars: int = ContextConfig.max_chars) -> DataFrame:
    """(query_id, question, context), with an empty context for queries without hits."""
    contexts = (
        context_parts(hits, max_chars)
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "part"))).alias("_parts"))
        .select(
            "query_id", F.array_join(F.transform("_parts", lambda p: p["part"]), CONTEXT_SEPARATOR).alias("context")
        )
    )
    return queries.select("query_id", "question").join(contexts, "query_id", "left").withColumn(
        "context", F.coalesce("context", F.lit(""))
    )


def build_prompt(queries: DataFrame, hits: DataFrame, max_chars: int = ContextConfig.max_chars) -> DataFrame:
    """(query_id, question, context, prompt)."""
    return build_context(queries, hits, max_chars).withColumn(
        "prompt",
        F.concat(
            F.lit(PROMPT_HEAD), F.col("context"), F.lit(PROMPT_QUESTION), F.col("question"), F.lit(PROMPT_TAIL)
        ),
    )


def extractive_answer(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, question, answer): the text of the best hit, or a fixed sentence."""
    best = hits.where("rank = 1").select("query_id", F.col("text").alias("answer"))
    return queries.select("query_id", "question").join(best, "query_id", "left").withColumn(
        "answer", F.coalesce("answer", F.lit(NO_ANSWER))
    )


def generated_answer(
    queries: DataFrame,
    hits: DataFrame,
    load: Callable[[], Callable[[Any], Any]],
    max_chars: int = ContextConfig.max_chars,
    batch_size: int = 64,
) -> DataFrame:
    """Answers of a caller's model: `load()` returns f(prompts) -> answers, once per Python worker."""

    def load_strings() -> Callable[[Any], Any]:
        model = load()
        return lambda prompts: np.array(list(model(prompts)), dtype=object)

    predict = predict_batch_udf(load_strings, return_type=T.StringType(), batch_size=batch_size)
    prompts = build_prompt(queries, hits, max_chars)
    return prompts.select("query_id", "question", predict(F.col("prompt")).alias("answer"))


def retrieved_lists(hits: DataFrame) -> DataFrame:
    """(query_id, retrieved): the hits of each query, at most k, as one array in rank order."""
    entry = F.struct("rank", "chunk_id", "doc_id", "text", "score")
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("retrieved"))


def package_results(queries: DataFrame, hits: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """(query_id, question, answer, retrieved), one row per query.

    Without `answers` the text of the best hit is the answer, taken from the
    same array, so the hits are computed once.
    """
    lists = retrieved_lists(hits)
    empty = F.array().cast(lists.schema["retrieved"].dataType)
    rows = (
        (queries.select("query_id", "question") if answers is None else answers)
        .join(lists, "query_id", "left")
        .withColumn("retrieved", F.coalesce("retrieved", empty))
    )
    if answers is None:
        best = F.get("retrieved", F.lit(0))["text"]
        rows = rows.withColumn("answer", F.coalesce(best, F.lit(NO_ANSWER)))
    return rows.select("query_id", "question", "answer", "retrieved")


def report(hits: DataFrame) -> DataFrame:
    """One line per hit: rank, score, id and the first 120 characters."""
    return hits.select(
        "query_id",
        "rank",
        F.round("score", 4).alias("score"),
        "chunk_id",
        snippet(F.col("text"), 120).alias("snippet"),
    )


def source_rows(hits: DataFrame, width: int = 300) -> DataFrame:
    """Attribution of each hit: text, ids, score and a longer snippet."""
    return hits.select(
        "query_id",
        "rank",
        "text",
        "chunk_id",
        "doc_id",
        "score",
        snippet(F.col("text"), width, ellipsis=True).alias("snippet"),
    )
