"""Retrieval metrics over tables of runs and relevance judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate(queries: DataFrame, runs: DataFrame, qrels: DataFrame, k: int) -> DataFrame:
    """(query_id, reciprocal_rank, recall, precision) for every query.

    `runs(query_id, rank, chunk_id)`, `qrels(query_id, chunk_id)`. Misses and
    queries without judgements score 0; precision divides by k even if fewer
    rows were retrieved.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    relevant = qrels.select("query_id", "chunk_id").distinct()
    wanted = relevant.groupBy("query_id").agg(F.count("*").alias("n_relevant"))
    found = (
        runs.select("query_id", "rank", "chunk_id")
        .join(relevant, ["query_id", "chunk_id"], "left_semi")
        .groupBy("query_id")
        .agg(F.min("rank").alias("first_rank"), F.count_if(F.col("rank") <= k).alias("n_found"))
    )
    hits = F.coalesce(F.col("n_found"), F.lit(0))
    return (
        queries.select("query_id")
        .join(wanted, "query_id", "left")
        .join(found, "query_id", "left")
        .select(
            "query_id",
            F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0)).alias("reciprocal_rank"),
            F.coalesce(F.try_divide(hits.cast("double"), F.col("n_relevant")), F.lit(0.0)).alias("recall"),
            (hits / F.lit(float(k)) if k else F.lit(0.0)).alias("precision"),
        )
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """One row: mrr, mean recall and mean precision."""
    return per_query.agg(
        F.avg("reciprocal_rank").alias("mrr"),
        F.avg("recall").alias("recall"),
        F.avg("precision").alias("precision"),
    )


def overlap_recall(found: DataFrame, truth: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(query_id, recall): share of the true top-k that another search also returned."""
    hit = found.select("query_id", key, F.lit(1).alias("hit"))
    return (
        truth.select("query_id", key)
        .join(hit, ["query_id", key], "left")
        .groupBy("query_id")
        .agg((F.count("hit") / F.count("*")).alias("recall"))
    )
