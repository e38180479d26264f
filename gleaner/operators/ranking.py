"""Top-k per query, shared by dense, sparse and fused lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.runtime import materialize

# Scores that agree to nine decimals are ties, whatever order their parts were added in.
RANK_SCALE = 1e9


def score_order(score: Column) -> Column:
    return F.rint(score * RANK_SCALE).desc()


def top_k(scored: DataFrame, k: int, *tie_break: Column, score: str = "score") -> DataFrame:
    """Best k rows of each query with their 1-based rank.

    Spark cuts to k inside every input partition (WindowGroupLimit) before the
    shuffle by query, so a query matching a third of the corpus moves only k rows per task.
    """
    order = Window.partitionBy("query_id").orderBy(score_order(F.col(score)), *tie_break)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positions(rows: DataFrame, *order: str, into: str = "position") -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given order, without gathering them in one task."""
    ordered = materialize(
        rows.orderBy(*order).select(
            *rows.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"),
        ),
        "positions",
    )
    # One row per sorted partition: a handful of counts, added up over all earlier partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(into, F.col("_before") + F.col("_local"))
        .select(*rows.columns, into)
    )
