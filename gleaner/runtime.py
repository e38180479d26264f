"""Where intermediate tables live, and the size checks behind every broadcast."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes up to which a table may be copied to every executor.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

# Folders made for local sessions that name none; the setting itself cannot be changed while a session runs.
_local_dirs: dict[str, str] = {}

# Bytes of rows that a Python worker is sent at once; a longer row comes alone.
ARROW_BYTES = 4 << 20
_ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temp folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="gleaner-")
    return _local_dirs[application]


def small_arrow_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python about `ARROW_BYTES` at a time, unless it has a setting of its own.

    A batch is held by the JVM outside its heap and by the worker as Arrow and as Python objects, and neither returns all of it.
    """
    if spark.conf.get(_ARROW_SETTING, None) is None:
        spark.conf.set(_ARROW_SETTING, str(ARROW_BYTES))


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None
) -> DataFrame:
    """Write once to shared storage and read back: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # Rebalanced by folder, a task writes few folders and a large folder is shared by many tasks.
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.options(**(options or {})).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at `path`, or None when nothing is there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def spread(df: DataFrame) -> DataFrame:
    """Share out rows when there are fewer input files than cores; otherwise leave them alone.

    One small file is one task, however many cores wait. A table of many files
    is already split and is not shuffled.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    return df.repartition(wanted) if 0 < len(files) < wanted else df


def busy_partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle whose rows are few bytes but much work each.

    A fixed number, as joining small partitions by their bytes would leave cores idle.
    """
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, 4 * spark.sparkContext.defaultParallelism)


def fits_broadcast(df: DataFrame, *text_columns: str, row_bytes: int = 64) -> bool:
    """Measure a table: may it be broadcast?"""
    size = F.lit(row_bytes)
    for name in text_columns:
        size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    rows, total = df.agg(F.count("*"), F.sum(size)).first()
    return rows <= BROADCAST_ROWS and (total or 0) <= BROADCAST_BYTES


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    rows_of_key: Column,
    rows_per_slice: int,
    spread_by: list[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join whose hot keys are cut into slices of at most about `rows_per_slice` rows.

    `small` holds each key's row count in `big` (`rows_of_key`). Keys above the
    slice size are few - their counts add up to no more than the rows of `big` -
    so they are broadcast to tell `big` its slices; `small` rows of those keys
    are repeated once per slice. All other keys keep slice 0. A row's slice is a
    hash of its `spread_by` columns, so a recomputed task cuts the same way.
    """
    slices = F.ceil(rows_of_key / F.lit(float(rows_per_slice))).cast("int")
    hot = small.select(key, slices.alias("_slices")).where("_slices > 1").distinct()
    left = (
        big.join(F.broadcast(hot), key, "left")
        .withColumn(
            "_slice",
            F.when(
                F.col("_slices").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int")
            ).otherwise(F.lit(0)),
        )
        .drop("_slices")
    )
    right = small.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))
    )
    return left.join(right, [key, "_slice"], how).drop("_slice")


def slice_rows(total: int, slices: int = 512) -> int:
    """Rows per slice so that at most `slices` keys can be hot."""
    return max(1, math.ceil(total / slices))
