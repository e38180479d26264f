import numpy as np
import pytest
from conftest import SF, plan_of
from pyspark.sql import functions as F

from gleaner.config import VectorIndexConfig
from gleaner.operators import dense
from gleaner.operators.dense import CellBounds, Cells, bounded_search, exact_search, ivf_search, tuned_nprobe
from gleaner.operators.evaluate import overlap_recall
from gleaner.runtime import materialize

VECTORS = "chunk_id string, doc_ord long, chunk_index int, embedding array<float>"


def make(spark, matrix):
    return spark.createDataFrame([(f"c{i}", i, 0, [float(x) for x in v]) for i, v in enumerate(matrix)], VECTORS)


def ask(spark, matrix):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "query_id long, embedding array<float>"
    )


def lists(hits):
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((int(r["chunk_id"][1:]), round(r["score"], 6)))
    return got


def brute(vectors, queries, k):
    scores = np.float32(queries).astype(float) @ np.float32(vectors).astype(float).T
    out = {}
    for q, row in enumerate(scores):
        best = sorted(range(len(row)), key=lambda i: (-round(row[i], 9), i))[:k]
        out[q] = [(i, round(row[i], 6)) for i in best]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[100:240] = vectors[0]  # a third of all rows are copies of one vector
    vectors[300] = 0
    return vectors, vectors[[0, 3, 250, 300, 399]]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("k", [1, 5, 200, 1000])
def test_exact_equals_brute_force(spark, data, monkeypatch, small, k):
    vectors, queries = data
    monkeypatch.setattr(dense, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(dense, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(dense, "_PRODUCT_CELLS", 500)
    hits = exact_search(ask(spark, queries), make(spark, vectors).repartition(3), k, dim=16, small_queries=small)
    assert lists(hits) == brute(vectors, queries, k)


def test_empty_sides_and_k_zero(spark, data):
    vectors, queries = data
    assert exact_search(ask(spark, queries), make(spark, vectors[:0]), 5, dim=16).count() == 0
    assert exact_search(ask(spark, queries[:0]), make(spark, vectors), 5, dim=16).count() == 0
    assert exact_search(ask(spark, queries), make(spark, vectors), 0, dim=16).count() == 0


def test_only_k_rows_per_task_are_shuffled(spark, data):
    vectors, queries = data
    plan = plan_of(exact_search(ask(spark, queries), make(spark, vectors), 5, dim=16))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "MapInPandas" in plan


@pytest.fixture(scope="module")
def stored(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.concat(F.lit("c"), F.col("vec_id").cast("string")).alias("chunk_id"),
        F.col("vec_id").alias("doc_ord"),
        F.lit(0).alias("chunk_index"),
        "embedding",
    )
    cells = Cells.train(table, VectorIndexConfig())
    return table, cells, materialize(cells.assign(table), "cells", ("cell",))


def test_cells_recall_grows_with_nprobe(spark, stored):
    table, cells, by_cell = stored
    queries = table.where("doc_ord < 100").select(F.col("doc_ord").alias("query_id"), "embedding")
    truth = exact_search(queries, table, 5, dim=64)
    recalls = []
    for nprobe in (10, 50, cells.nlist):
        for small in (True, False):
            found = ivf_search(queries, by_cell, cells, 5, nprobe, dim=64, small_queries=small)
            recalls.append(overlap_recall(found, truth).agg(F.round(F.avg("recall"), 9)).first()[0])
    assert recalls[0] == recalls[1] <= recalls[2] == recalls[3] and recalls[2] > 0.9
    assert recalls[4:] == [1.0, 1.0]
    assert lists(ivf_search(queries, by_cell, cells, 5, cells.nlist, dim=64)) == lists(truth)


def test_probed_cells_prune_the_scan(spark, stored):
    table, cells, by_cell = stored
    queries = table.where("doc_ord = 3").select(F.col("doc_ord").alias("query_id"), "embedding")
    plan = ivf_search(queries, by_cell, cells, 5, 2, dim=64)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan


def test_zero_vectors_are_stored_in_the_lowest_cell(spark, stored):
    _, cells, _ = stored
    zero = make(spark, np.zeros((1, 64)))
    assert cells.assign(zero).first()["cell"] == 0


def test_training_skips_zero_vectors(spark, data):
    vectors, _ = data
    cells = Cells.train(make(spark, vectors), VectorIndexConfig(nlist=4))
    assert cells.nlist == 4
    sizes = cells.assign(make(spark, vectors)).groupBy("cell").count().collect()
    assert sum(r["count"] for r in sizes) == len(vectors)
    again = Cells.from_frame(cells.to_frame(spark))
    assert np.allclose(again.centers, cells.centers)


def test_query_blocks_leave_vectors_in_place(spark, data, monkeypatch):
    """One round per block of queries, and no exchange below the search itself."""
    vectors, queries = data
    monkeypatch.setattr(dense, "BLOCK_QUERIES", 2)
    plans, mapped = [], type(make(spark, vectors)).mapInPandas

    def seen(frame, *args, **more):
        plans.append(plan_of(frame))
        return mapped(frame, *args, **more)

    monkeypatch.setattr(type(make(spark, vectors)), "mapInPandas", seen)
    hits = exact_search(ask(spark, queries), make(spark, vectors), 5, dim=16, small_queries=False)
    assert lists(hits) == brute(vectors, queries, 5)
    assert len(plans) >= 2 and not any("Exchange" in p for p in plans)


def test_nearest_cells_in_order():
    rng = np.random.default_rng(3)
    scores = np.round(rng.integers(0, 6, (50, 90)) / 3, 9)  # many ties
    for count in (1, 4, 40, 90, 200):
        want = np.argsort(-scores, axis=1, kind="stable")[:, :count]
        assert (dense._first(scores, count) == want).all()


def clustered(n=600, dim=16, groups=12, spread=0.15, seed=9):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    rows = centers[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    rows *= rng.uniform(0.2, 3, (n, 1))  # norms differ
    rows[::50] = 0
    return rows


def test_bounds_hold_for_every_vector(spark):
    rows = clustered()
    table = make(spark, rows)
    cells = Cells.train(table, VectorIndexConfig(nlist=12))
    stored = materialize(cells.assign(table), "cells", ("cell",))
    bounds = CellBounds.measure(stored, cells)
    cell = {int(r["chunk_id"][1:]): r["cell"] for r in stored.collect()}
    queries = np.r_[rows[:40], np.random.default_rng(1).normal(size=(40, 16)), np.zeros((1, 16))]
    most = bounds.highest(queries, cells)
    products = queries @ np.float32(rows).astype(float).T
    for i in range(len(rows)):
        assert (products[:, i] <= most[:, cell[i]] + 1e-6).all()
    assert bounds.n.sum() == len(rows)


@pytest.mark.parametrize("first", [1, 3, 50])
def test_bounded_search_is_exact_and_skips_cells(spark, first):
    rows = clustered()
    table = make(spark, rows)
    cells = Cells.train(table, VectorIndexConfig(nlist=12))
    stored = materialize(cells.assign(table), "cells", ("cell",))
    bounds = CellBounds.measure(stored, cells)
    queries = np.r_[rows[1:30], -rows[1:3], np.zeros((1, 16))]
    for k in (1, 5, 700):
        hits, work = bounded_search(ask(spark, queries), stored, cells, bounds, k, dim=16, first=first)
        assert lists(hits) == brute(rows, queries, k)
        scored = {r["query_id"]: r["vectors"] for r in work.collect()}
        assert len(scored) == len(queries) and all(n <= len(rows) for n in scored.values())
        if k == 5 and first == 1:
            assert sum(scored[i] for i in range(29)) < 0.5 * 29 * len(rows)


def test_bounded_search_with_narrower_bounds_stops_earlier(spark, stored):
    table, cells, by_cell = stored
    queries = table.where("doc_ord < 100").select(F.col("doc_ord").alias("query_id"), "embedding")
    truth = exact_search(queries, table, 5, dim=64)
    shares, recalls = [], []
    for slack in (1.0, 0.3):
        bounds = CellBounds.measure(by_cell, cells, slack)
        hits, work = bounded_search(queries, by_cell, cells, bounds, 5, dim=64)
        recalls.append(overlap_recall(hits, truth).agg(F.avg("recall")).first()[0])
        shares.append(work.agg(F.sum("vectors")).first()[0])
    assert recalls[0] == 1.0 and recalls[1] >= 0.9 and shares[1] < shares[0]


def test_bounded_search_of_nothing(spark, data):
    vectors, queries = data
    table = make(spark, vectors)
    cells = Cells.train(table, VectorIndexConfig(nlist=4))
    none = cells.assign(make(spark, vectors[:0]))
    bounds = CellBounds.measure(none, cells)
    hits, work = bounded_search(ask(spark, queries), none, cells, bounds, 5, dim=16)
    assert hits.count() == 0 and work.agg(F.sum("vectors")).first()[0] == 0


def test_tuned_cells_reach_the_recall(spark, stored):
    table, cells, by_cell = stored
    queries = table.select(F.col("doc_ord").alias("query_id"), "embedding")
    nprobe = tuned_nprobe(queries.where("query_id % 2 = 0"), by_cell, cells, 5, 0.95, dim=64)
    assert 1 < nprobe < cells.nlist
    truth = exact_search(queries, table, 5, dim=64)
    recall = lambda n: overlap_recall(ivf_search(queries, by_cell, cells, 5, n, dim=64), truth).agg(F.avg("recall")).first()[0]
    assert recall(nprobe) >= 0.94 > recall(nprobe // 4)
    assert tuned_nprobe(queries.where("query_id < 0"), by_cell, cells, 5, 0.95, dim=64) == cells.nlist
