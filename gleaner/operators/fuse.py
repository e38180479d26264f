"""Weighted reciprocal rank fusion of two ranked lists per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import RetrievalConfig
from gleaner.operators.ranking import top_k


def _share(weight: float, rrf_k: int, rank: Column) -> Column:
    return F.coalesce(F.lit(weight) / (F.lit(float(rrf_k)) + rank), F.lit(0.0))


def rrf(dense: DataFrame, sparse: DataFrame, cfg: RetrievalConfig = RetrievalConfig()) -> DataFrame:
    """(query_id, chunk_id, dense_rank, sparse_rank, score); a list without the chunk adds nothing.

    One aggregation over both lists instead of an outer join: one shuffle of
    at most dense_candidates + sparse_candidates rows per query.
    """
    none = F.lit(None).cast("int")
    lists = dense.select("query_id", "chunk_id", F.col("rank").alias("dense_rank"), none.alias("sparse_rank")).unionByName(
        sparse.select("query_id", "chunk_id", none.alias("dense_rank"), F.col("rank").alias("sparse_rank"))
    )
    ranks = lists.groupBy("query_id", "chunk_id").agg(
        F.min("dense_rank").alias("dense_rank"), F.min("sparse_rank").alias("sparse_rank")
    )
    return ranks.withColumn(
        "score",
        _share(cfg.dense_weight, cfg.rrf_k, F.col("dense_rank"))
        + _share(cfg.sparse_weight, cfg.rrf_k, F.col("sparse_rank")),
    )


def fused_top_k(dense: DataFrame, sparse: DataFrame, k: int, cfg: RetrievalConfig = RetrievalConfig()) -> DataFrame:
    """Best k fused chunks of each query; equal scores keep dense order, then sparse order."""
    return top_k(
        rrf(dense, sparse, cfg), k, F.col("dense_rank").asc_nulls_last(), F.col("sparse_rank").asc_nulls_last()
    )
