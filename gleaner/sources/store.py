"""An index on shared storage: parquet tables per batch and a versioned manifest.

A batch is visible once its manifest row is written, and not before. A failed
attempt leaves files that the next attempt with the same number overwrites, so
appends can be retried at any point. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.sparse import unlisted
from gleaner.runtime import read_table

FORMAT = 1


@dataclass(frozen=True)
class Manifest:
    config: str = ""
    batches: int = 0
    labels: list[str] = field(default_factory=list)
    n_chunks: int = 0
    total_length: int = 0
    next_ord: int = 0
    # Number of the batch that wrote the current cells; None while search is exhaustive.
    cells: int | None = None
    # Cells that a question looks into, where that number was measured.
    nprobe: int | None = None
    # Runs of batches whose term counts and id filters lie together: [level, first, last].
    tiers: list[list[int]] = field(default_factory=list)
    # Batches that replaced earlier chunks.
    replaced: list[int] = field(default_factory=list)
    format: int = FORMAT

    def with_(self, **changes) -> "Manifest":
        return replace(self, **changes)


# Tables that lie by run of batches; a run may hold no row of them.
TIERED = {
    "terms": "term string, df bigint, bucket int, tier string",
    "df_counts": "df bigint, n bigint, tier string",
    "filters": "kind string, slice int, slices int, bits binary, tier string",
    "ids": "doc_id string, chunk_id string, dl int, folder int, tier string",
}
# Runs of one level that are merged into one of the next.
MERGED = 4


def grown(tiers: list[list[int]], batch: int) -> tuple[list[list[int]], list[list[list[int]]]]:
    """The runs after a batch was added, and the groups of runs to be merged for it, one after the other.

    A batch's rows are merged once per level, so all merges together read and write each row a logarithmic number of times.
    """
    now, merges = [*tiers, [0, batch, batch]], []
    while len(now) >= MERGED and len({t[0] for t in now[-MERGED:]}) == 1:
        group = now[-MERGED:]
        merges.append(group)
        now = [*now[:-MERGED], [group[0][0] + 1, group[0][1], group[-1][2]]]
    return now, merges


def tier_name(tier: list[int]) -> str:
    return f"b{tier[1]}_{tier[2]}"


# Bytes from which a task writes its rows of a folder as a file of its own, without a shuffle that gathers folders.
FILE_BYTES = 64 << 10


def gathers(rows: DataFrame, folders: int, size: int) -> bool:
    """Whether the tasks of `rows`, of about `size` bytes, may write to all folders without many small files."""
    return size >= FILE_BYTES * folders * rows.rdd.getNumPartitions()


class IndexStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.version = -1

    def latest(self) -> Manifest | None:
        """The newest committed manifest; later commits continue its version number."""
        try:
            versions = self.spark.read.schema("body string, v int").parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        row = versions.orderBy(F.col("v").desc()).first()
        if row is None:
            return None
        self.version = row["v"]
        return Manifest(**json.loads(row["body"]))

    def commit(self, manifest: Manifest) -> None:
        """Publish the next version; fails if another writer took its number."""
        row = self.spark.createDataFrame([(json.dumps(asdict(manifest)),)], "body string")
        row.coalesce(1).write.mode("error").parquet(f"{self.path}/manifest/v={self.version + 1}")
        self.version += 1

    def write(
        self, df: DataFrame, table: str, batch: int, partition_by: str | None = None, gathered: bool = False,
        options: dict[str, str] | None = None,
    ) -> None:
        """`gathered` rows are read from such folders already, or are many to each task and folder, and are not shuffled."""
        writer = df.write.mode("overwrite")
        if partition_by:
            rows = df if gathered else df.hint("rebalance", partition_by)
            writer = rows.write.mode("overwrite").partitionBy(partition_by)
        writer.options(**(options or {})).parquet(f"{self.path}/{table}/batch={batch}")

    def write_tier(self, df: DataFrame, table: str, tier: list[int], partition_by: str | None = None) -> None:
        rows = df.hint("rebalance", partition_by) if partition_by else df
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.path}/{table}/tier={tier_name(tier)}")

    def read_tiers(self, table: str, tiers: list[list[int]]) -> DataFrame | None:
        """Rows of some runs, with their `tier`."""
        paths = [f"{self.path}/{table}/tier={tier_name(t)}" for t in tiers]
        if not paths:
            return None
        return self.spark.read.schema(TIERED[table]).option("basePath", f"{self.path}/{table}").parquet(*paths)

    def table(self, table: str, manifest: Manifest, since: int = 0) -> DataFrame | None:
        """Committed rows of a table as they were written."""
        rows = read_table(self.spark, f"{self.path}/{table}")
        return None if rows is None else rows.where((F.col("batch") < manifest.batches) & (F.col("batch") >= since))

    def _postings(self, manifest: Manifest, since: int) -> DataFrame | None:
        """A row per posting, of lists and of batches that an earlier version wrote row by row."""
        lists, rows = (self.table(name, manifest, since) for name in ("posting_lists", "postings"))
        if lists is None:
            return rows
        listed = unlisted(lists, "bucket", "batch")
        if rows is None:
            return listed
        # An attempt that failed before its batch was written as lists may have left rows.
        rows = rows.join(F.broadcast(lists.select("batch").distinct()), "batch", "left_anti")
        return listed.unionByName(rows)

    def read(self, table: str, manifest: Manifest, since: int = 0) -> DataFrame | None:
        """Committed rows of a table, row by row; rows of replaced chunks are left out."""
        rows = self._postings(manifest, since) if table == "postings" else self.table(table, manifest, since)
        if rows is None:
            return None
        if manifest.replaced and "chunk_id" in rows.columns:
            gone = self.dropped(manifest)
            rows = rows.join(
                gone, (rows["chunk_id"] == gone["gone_id"]) & (rows["batch"] < gone["gone_in"]), "left_anti"
            )
        return rows

    def dropped(self, manifest: Manifest) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/dropped").where(F.col("batch").isin(manifest.replaced))
        return rows.select(F.col("chunk_id").alias("gone_id"), F.col("batch").alias("gone_in"))
