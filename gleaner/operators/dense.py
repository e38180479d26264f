"""Inner-product search over a vector table, exhaustive or by k-means cell.

Both searches are one job shape: a vector belongs to a cell, a query looks into
some cells, and inside a task a block of vectors is multiplied with a block of
queries. Vectors stay where they are stored; queries beyond a broadcast come in rounds of one bounded block each.
Only the best k rows per query leave the task; pairs are never rows.

Search by cell can be exact: a cell's radius and norms bound every product with a vector in it, so a
query visits cells from the highest bound down and is done when none that is left can reach its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.config import VectorIndexConfig
from gleaner.functions.vectors import norm
from gleaner.operators.ranking import top_k
from gleaner.runtime import materialize, scratch_path

# Vectors multiplied at once, and queries of one round.
BLOCK_VECTORS = 65_536
BLOCK_QUERIES = 65_536
# Bytes of the queries of one round: they pass through the driver, as arrays, and lie in every task.
BROADCAST_BYTES = 16 << 20
# Bytes of a cell that a query looks into, in every task.
_LOOK_BYTES = 8
# Scores held at once: even if all of them tie, they fit a task.
_PRODUCT_CELLS = 4_000_000
# Hits that wait to be settled, besides k of each query.
_WAITING_HITS = 1_000_000


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    if len(column) == 0:
        return np.empty((0, dim))
    return np.stack(column.to_numpy()).astype(np.float64)


def _best(hits: pd.DataFrame, k: int, order: list[str]) -> pd.DataFrame:
    """First k rows of each query: highest score to nine decimals, then `order`."""
    ranked = hits.assign(_key=-np.rint(hits["score"] * 1e9)).sort_values(["_key", *order], kind="stable")
    return ranked.groupby("_q", sort=False).head(k).drop(columns="_key")


class _Kept:
    """The k highest scores of each query so far, as numbers alone: what a vector must reach to be looked at."""

    def __init__(self, queries: int, k: int):
        self.k, self.scores, self.floor = k, np.full((queries, k), -np.inf), np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray) -> None:
        """More scores, in the order of their queries."""
        ids, first, size = np.unique(query, return_index=True, return_counts=True)
        of = np.repeat(np.arange(len(ids)), size)
        number = np.concatenate([of, np.repeat(np.arange(len(ids)), self.k)])
        both = np.concatenate([score, self.scores[ids].ravel()])
        order = np.lexsort((-both, number))
        place = np.arange(len(both)) - np.repeat(first + self.k * np.arange(len(ids)), size + self.k)
        self.scores[ids] = both[order][place < self.k].reshape(len(ids), self.k)
        self.floor[ids] = self.scores[ids, -1]


def _block_hits(block: np.ndarray, queries: np.ndarray, ids: np.ndarray, kept: _Kept) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows of a vector block, queries, scores) that can be among the first k of the given queries, some queries at a time."""
    k, step = kept.k, max(1, _PRODUCT_CELLS // max(1, len(block)))
    for at in range(0, len(ids), step):
        own = ids[at : at + step]
        scores, reach = queries[own] @ block.T, kept.floor[own]
        new = np.flatnonzero(np.isneginf(reach)) if len(block) > k else ()
        if len(new):
            reach[new] = np.partition(scores[new], len(block) - k, axis=1)[:, len(block) - k]
        # Everything that reaches the k-th score stays, so ties are settled by `order`.
        cols, rows = np.nonzero(scores >= reach[:, None] - 1e-9)
        if len(rows):
            found = scores[cols, rows]
            kept.add(own[cols], found)
            yield rows, own[cols], found


def _scan_search(
    names: np.ndarray, vectors: np.ndarray, probes: dict[int, np.ndarray], k: int, id_col: str, order: list[str], dim: int
):
    """Task body: run over the vectors of a partition, keep k hits per query."""
    keep = list(dict.fromkeys([id_col, *order]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = vectors.astype(np.float64)  # sent as they are stored
        kept, waiting, held, most = _Kept(len(names), k), [], 0, _WAITING_HITS

        def best() -> pd.DataFrame:
            hits = pd.concat(waiting, ignore_index=True)
            # Most of what was good enough at first is not by now.
            return _best(hits[hits["score"].to_numpy() >= kept.floor[hits["_q"].to_numpy()] - 1e-9], k, order)

        for batch in batches:
            for cell, rows in batch.groupby("cell", sort=False):
                ids = probes.get(int(cell))
                if ids is None:
                    continue
                for at in range(0, len(rows), BLOCK_VECTORS):
                    part = rows.iloc[at : at + BLOCK_VECTORS]
                    own = part[keep]
                    for row, query, score in _block_hits(_matrix(part["embedding"], dim), matrix, ids, kept):
                        waiting.append(own.iloc[row].assign(_q=query, score=score))
                        held += len(row)
                        if held > most:  # settled seldom, as each time sorts all that is held
                            waiting = [best()]
                            held = len(waiting[0])
                            most = _WAITING_HITS + held
        if waiting:
            found = best()
            out = found.assign(query_id=names[found["_q"].to_numpy()])
            yield out[["query_id", *keep, "score"]]

    return run


def _result_schema(queries: DataFrame, vectors: DataFrame, id_col: str, order: list[str]) -> T.StructType:
    keep = list(dict.fromkeys([id_col, *order]))
    fields = [T.StructField("query_id", queries.schema["query_id"].dataType)]
    fields += [T.StructField(c, vectors.schema[c].dataType) for c in keep]
    return T.StructType([*fields, T.StructField("score", T.DoubleType())])


def cell_search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    *,
    dim: int,
    id_col: str = "chunk_id",
    order: tuple[str, ...] = ("doc_ord", "chunk_index"),
    probes: DataFrame | None = None,
    small_queries: bool | None = None,
) -> DataFrame:
    """Top-k vectors of each query among the cells it probes; all vectors when `probes` is None.

    `queries(query_id, embedding)`, `vectors(<id>, embedding[, cell])`, `probes(query_id, cell)`.
    """
    by = list(order)
    schema = _result_schema(queries, vectors, id_col, by)
    keep = list(dict.fromkeys([id_col, *by]))
    if k == 0:
        return top_k(queries.sparkSession.createDataFrame([], schema), 0, *(F.col(c).asc() for c in by))
    asked = queries.select("query_id", F.col("embedding").cast("array<float>").alias("embedding"))
    if probes is None:
        stored = vectors.select(*keep, "embedding", F.lit(0).alias("cell"))
        looks = asked.withColumn("cell", F.lit(0))
    else:
        stored = vectors.select(*keep, "embedding", "cell")
        looks = asked.join(probes, "query_id")
    def search(looks: DataFrame) -> DataFrame:
        """The query vectors fit in every task, so the vectors stay where they are."""
        table = looks.groupBy("query_id").agg(
            F.any_value("embedding").alias("embedding"), F.collect_list("cell").alias("cells")
        )
        known = table.toArrow()
        by_cell = _queries_by_cell(known["cells"].combine_chunks())
        # Literal cells prune the partitions of a table stored by cell.
        rows = stored if probes is None else stored.where(F.col("cell").isin(sorted(by_cell)))
        return rows.mapInPandas(_scan_search(_names(known["query_id"]), _vectors(known["embedding"].combine_chunks(), dim), by_cell, k, id_col, by, dim), schema)

    ties = [F.col(c).asc() for c in by]
    # A vector of each query, and a number for each cell that it looks into.
    size = looks.groupBy("query_id").agg(F.count("*").alias("n")).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    wanted = size[0] * (4 * dim + 64) + size[1] * _LOOK_BYTES
    if small_queries is None:
        small_queries = wanted <= BROADCAST_BYTES
    if small_queries:
        return top_k(search(looks), k, *ties)
    rounds = max(1, -(-size[0] // BLOCK_QUERIES), -(-wanted // BROADCAST_BYTES))
    return _in_rounds(looks, lambda block: top_k(search(block), k, *ties), rounds)


def _names(ids: pa.ChunkedArray) -> np.ndarray:
    return ids.to_numpy() if ids.null_count == 0 else np.array(ids.to_pylist(), object)


def _vectors(column: pa.ListArray, dim: int) -> np.ndarray:
    """A row per query, as 32-bit numbers."""
    if column.null_count or (np.diff(column.offsets.to_numpy()) != dim).any():
        raise ValueError(f"a query's vector is missing or has not {dim} numbers")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(len(column), dim)


def _queries_by_cell(cells: pa.ListArray) -> dict[int, np.ndarray]:
    """The places of the queries that look into each cell."""
    cell = cells.flatten().to_numpy()
    query = np.repeat(np.arange(len(cells), dtype=np.int32), np.diff(cells.offsets.to_numpy()))
    order = np.argsort(cell, kind="stable")
    known, first = np.unique(cell[order], return_index=True)
    return dict(zip(known.tolist(), np.split(query[order], first[1:])))


def _in_rounds(looks: DataFrame, search, rounds: int) -> DataFrame:
    """Queries beyond a broadcast: bounded blocks of whole queries, each searched and written before the next one."""
    spark = looks.sparkSession
    # Written by block: a round reads its own folder.
    cut = looks.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(rounds)).cast("int"))
    cut, path = materialize(cut, "query-blocks", ("block",)), scratch_path(spark, "round-hits")
    for block in range(rounds):
        hits = search(cut.where(F.col("block") == block).drop("block"))
        hits.write.mode("append").parquet(path)
    return spark.read.schema(hits.schema).parquet(path)


@dataclass(frozen=True)
class Cells:
    """Trained cell centres: nlist rows, small enough for the driver by configuration."""

    centers: np.ndarray

    @property
    def nlist(self) -> int:
        return len(self.centers)

    @classmethod
    def train(cls, vectors: DataFrame, cfg: VectorIndexConfig) -> "Cells":
        """Spherical k-means with MLlib, as a Spark job over all vectors that have a direction."""
        usable = vectors.where(norm(F.col("embedding")) > 0).select("embedding")
        # Written once: training passes over it many times.
        usable = materialize(usable, "training").select(array_to_vector(F.col("embedding")).alias("features"))
        model = KMeans(k=cfg.nlist, distanceMeasure="cosine", seed=cfg.seed, maxIter=20).fit(usable)
        centers = np.array(model.clusterCenters())
        return cls(centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12))

    def to_frame(self, spark) -> DataFrame:
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centers)]
        return spark.createDataFrame(rows, "cell int, centroid array<double>")

    @classmethod
    def from_frame(cls, frame: DataFrame) -> "Cells":
        rows = frame.orderBy("cell").collect()
        return cls(np.array([r["centroid"] for r in rows]))

    def _nearest(self, df: DataFrame, count: int) -> DataFrame:
        centers, fields = self.centers, df.schema.fields
        schema = T.StructType([*fields, T.StructField("cell", T.ArrayType(T.IntegerType()))])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                step = max(1, _PRODUCT_CELLS // len(centers))
                for at in range(0, len(batch), step):
                    part = batch.iloc[at : at + step]
                    # Rounded, so a tie (as for the zero vector) goes to the lowest cell.
                    scores = np.round(_matrix(part["embedding"], centers.shape[1]) @ centers.T, 9)
                    yield part.assign(cell=list(_first(scores, count)))

        return df.mapInPandas(run, schema)

    def assign(self, vectors: DataFrame) -> DataFrame:
        """Add the cell of each vector."""
        return self._nearest(vectors, 1).withColumn("cell", F.col("cell")[0])

    def probes(self, queries: DataFrame, nprobe: int) -> DataFrame:
        """(query_id, cell): the nprobe closest cells of each query."""
        near = self._nearest(queries.select("query_id", "embedding"), min(nprobe, self.nlist))
        return near.select("query_id", F.explode("cell").alias("cell"))


def _first(scores: np.ndarray, count: int) -> np.ndarray:
    """Columns of the `count` highest scores of each row, in order; ties go to the lower column."""
    rows, width = scores.shape
    if count == 1:
        return scores.argmax(axis=1).astype(np.int32)[:, None]
    if count >= width or 8 * count > width:
        return np.argsort(-scores, axis=1, kind="stable")[:, :count].astype(np.int32)
    kth = np.partition(scores, width - count, axis=1)[:, width - count]
    found = np.empty((rows, count), np.int32)
    for i in range(rows):
        near = np.flatnonzero(scores[i] >= kth[i])
        found[i] = near[np.argsort(-scores[i, near], kind="stable")[:count]]
    return found


@dataclass(frozen=True)
class CellBounds:
    """What is known of the vectors in each cell: their number, norms, and how far they lie from the centre.

    `angle` is the largest angle to the centre, times `slack`; with a slack of 1 bounds are never too low.
    """

    n: np.ndarray
    angle: np.ndarray
    least_norm: np.ndarray
    most_norm: np.ndarray
    slack: float = 1.0

    @classmethod
    def measure(cls, stored: DataFrame, cells: Cells, slack: float = 1.0) -> "CellBounds":
        """One pass over vectors stored with their `cell`; a row per cell comes to the driver."""
        centers = cells.centers

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = _matrix(batch["embedding"], centers.shape[1])
                length = np.linalg.norm(own, axis=1)
                cosine = (own * centers[batch["cell"].to_numpy()]).sum(axis=1) / np.maximum(length, 1e-300)
                # A vector without direction has a product of zero with everything; its norm says so.
                angle = np.where(length > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)
                yield pd.DataFrame({"cell": batch["cell"], "angle": angle, "norm": length})

        rows = stored.select("cell", "embedding").mapInPandas(work, "cell int, angle double, norm double")
        found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("angle"), F.min("norm").alias("low"), F.max("norm").alias("high"))
        n, angle, low, high = np.zeros(cells.nlist, np.int64), *(np.zeros(cells.nlist) for _ in range(3))
        for r in found.collect():
            n[r["cell"]], angle[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["angle"], r["low"], r["high"]
        return cls(n, angle * slack, low, high, slack)

    def highest(self, queries: np.ndarray, cells: Cells) -> np.ndarray:
        """The most that a product of each query with a vector of each cell can be; -inf for empty cells."""
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        between = np.arccos(np.clip(queries @ cells.centers.T / np.maximum(length, 1e-300), -1, 1))
        cosine = np.cos(np.maximum(0.0, between - self.angle - 1e-7))
        most = length * np.where(cosine > 0, cosine * self.most_norm, cosine * self.least_norm)
        return np.where(self.n > 0, most + 1e-9, -np.inf)


def bounded_search(
    queries: DataFrame,
    vectors: DataFrame,
    cells: Cells,
    bounds: CellBounds,
    k: int,
    *,
    dim: int,
    first: int = 4,
    id_col: str = "chunk_id",
    order: tuple[str, ...] = ("doc_ord", "chunk_index"),
) -> tuple[DataFrame, DataFrame]:
    """(top-k hits, vectors scored per query): cells in rounds from the highest bound down, until none can reach the k-th score.

    The first round visits `first` cells, each later one four times as many. Bounds with a slack of 1 make the hits exact; less stops earlier.
    """
    spark = queries.sparkSession
    ties = [F.col(c).asc() for c in order]
    asked = materialize(queries.select("query_id", F.col("embedding").cast("array<float>").alias("embedding")), "asked")
    kind = queries.schema["query_id"].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("vectors", T.LongType())])

    def next_cells(seen: int, upto: int):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                step = max(1, _PRODUCT_CELLS // cells.nlist)
                for at in range(0, len(batch), step):
                    part = batch.iloc[at : at + step]
                    most = bounds.highest(_matrix(part["embedding"], dim), cells)
                    by_bound = np.argsort(-most, axis=1, kind="stable")[:, seen:upto]
                    wanted = np.take_along_axis(most, by_bound, 1) >= part["kth"].to_numpy()[:, None] - 2e-9
                    wanted &= np.isfinite(np.take_along_axis(most, by_bound, 1))
                    look = [row[w].astype(np.int32) for row, w in zip(by_bound, wanted)]
                    made = pd.DataFrame({"query_id": part["query_id"].to_numpy(), "cells": look, "vectors": [int(bounds.n[c].sum()) for c in look]})
                    yield made[made["vectors"] > 0]

        return work

    best, looked, seen, width = None, [], 0, max(1, first)
    while seen < cells.nlist:
        if best is None:
            open_queries = asked.withColumn("kth", F.lit(float("-inf")))
        else:
            kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
            open_queries = asked.join(kth, "query_id", "left").fillna(float("-inf"), ["kth"])
        looks = materialize(open_queries.mapInPandas(next_cells(seen, seen + width), schema), "round-cells")
        seen, width = seen + width, 4 * width
        if looks.isEmpty():  # cells that come later have lower bounds
            break
        looked.append(looks.select("query_id", "vectors"))
        probes = looks.select("query_id", F.explode("cells").alias("cell"))
        found = cell_search(asked, vectors, k, dim=dim, id_col=id_col, order=order, probes=probes).drop("rank")
        best = materialize(top_k(found if best is None else best.drop("rank").unionByName(found), k, *ties), "round-best")
    if best is None:
        best = cell_search(asked, vectors, k, dim=dim, id_col=id_col, order=order)
        return best, asked.select("query_id", F.lit(0).cast("bigint").alias("vectors"))
    work = looked[0]
    for more in looked[1:]:
        work = work.unionByName(more)
    return best, work.groupBy("query_id").agg(F.sum("vectors").alias("vectors"))


def tuned_nprobe(sample: DataFrame, stored: DataFrame, cells: Cells, k: int, recall: float, *, dim: int,
                 id_col: str = "chunk_id", order: tuple[str, ...] = ("doc_ord", "chunk_index")) -> int:
    """The fewest cells at which a sample of queries finds `recall` of its true k nearest, less two standard errors.

    `sample` is a bounded table of queries; each is searched exhaustively once. For every true hit the place of its cell in
    the query's order tells from which number of cells on it is found.
    """
    queries = materialize(sample.select("query_id", "embedding"), "recall-sample")
    truth = exact_search(queries, stored.drop("cell"), k, dim=dim, id_col=id_col, order=order).select("query_id", id_col)
    rows = truth.join(stored.select(id_col, "cell"), id_col).join(queries, "query_id").toPandas()
    if not len(rows):
        return cells.nlist
    scores = np.round(_matrix(rows["embedding"], dim) @ cells.centers.T, 9)
    by_score = np.argsort(-scores, axis=1, kind="stable")
    place = (by_score == rows["cell"].to_numpy()[:, None]).argmax(axis=1)
    hits = pd.crosstab(rows["query_id"], place).reindex(columns=range(cells.nlist), fill_value=0).to_numpy()
    found = np.cumsum(hits, axis=1) / hits.sum(axis=1, keepdims=True)
    sure = found.mean(axis=0) - 2 * found.std(axis=0) / np.sqrt(len(found))
    enough = np.flatnonzero((sure >= recall) | (found.min(axis=0) >= 1))
    return int(enough[0]) + 1 if len(enough) else cells.nlist


def exact_search(queries: DataFrame, vectors: DataFrame, k: int, *, dim: int, **options) -> DataFrame:
    return cell_search(queries, vectors, k, dim=dim, **options)


def ivf_search(
    queries: DataFrame, vectors: DataFrame, cells: Cells, k: int, nprobe: int, *, dim: int, **options
) -> DataFrame:
    """Search only the nprobe nearest cells; `vectors` carries `cell`."""
    return cell_search(queries, vectors, k, dim=dim, probes=cells.probes(queries, nprobe), **options)
