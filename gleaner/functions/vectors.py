"""Vector functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import let


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(vector: Column) -> Column:
    """Unit length; the zero vector stays as it is."""
    return let(
        norm(vector),
        lambda n: F.when(n > 0, F.transform(vector, lambda x: x.cast("double") / n)).otherwise(
            F.transform(vector, lambda x: x.cast("double"))
        ),
    )


def dimensions(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The distinct vector lengths of a table with their row counts; more than one row is an error."""
    return vectors.groupBy(F.size(column).alias("dim")).agg(F.count("*").alias("n"))


def require_dimension(vectors: DataFrame, column: str = "embedding") -> int:
    """The common vector length (0 for an empty table)."""
    low, high = vectors.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if low != high:
        raise ValueError(f"vectors differ in length: {low} to {high}")
    return low or 0
